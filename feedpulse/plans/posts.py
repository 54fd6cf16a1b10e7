"""Posts derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_posts(documents: DataFrame) -> DataFrame:
    """Documents as posts: the first line is the title, the rest the body."""
    newline = F.instr("text", "\n")
    if "created_at" not in documents.columns:
        documents = documents.withColumn("created_at", F.lit(None).cast("timestamp"))
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        "created_at",
        F.col("source").alias("subreddit"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(newline > 0, F.substr("text", newline + 1)).otherwise("").alias("text"),
        F.lit("submission").alias("type"),
    )


def load_documents(
    spark: SparkSession, sf_dir: str, partitions: int | None = None
) -> DataFrame:
    """The documents as they are read, or spread over ``partitions`` by the caller.

    Spreading moves all texts; it pays where a table comes in fewer splits than
    there are cores and each row takes long, as with a slow model.
    """
    documents = load(spark, sf_dir, "documents")
    return documents.repartition(partitions, "doc_id") if partitions else documents


def untimed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_posts(load_documents(spark, sf_dir))


def timed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with the time of the event of the same number.

    Both sides are keyed by a unique number, so neither can be skewed; Spark
    broadcasts the events only where their size is under its threshold.
    """
    times = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("created_at")
    )
    return as_posts(load_documents(spark, sf_dir).join(times, "doc_id"))
