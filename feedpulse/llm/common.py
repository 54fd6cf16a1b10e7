"""Tables of intermediate rows, row keys and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.session import shared_folder

#: Name of the row key that operators add; callers' columns keep their names.
ROW = "_llm_row"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Hands texts to Python in batches of few rows while it lasts.

    A batch is in memory on both sides, and the buffers of a large one are kept.
    Only what is computed inside is affected; the caller's setting comes back.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores at its end until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def row_key(docs: DataFrame) -> DataFrame:
    """Adds ``_llm_row``: tells rows apart where ids are null or come twice.

    The key depends on how a scan is split, and Spark splits by the cores it has, so two
    scans may disagree. Use it where rows are read once, or are stored with it:
    :func:`keyed_rows`.
    """
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def keyed_rows(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of every row under a row key, stored together: the key stays its own."""
    return written(docs.select(F.monotonically_increasing_id().alias(ROW), *columns), "rows")


def keyed_documents(docs: DataFrame) -> DataFrame:
    """``(row, doc)``: whole rows of ``docs`` under a row key, stored.

    Within ``doc`` the columns can have any name.
    """
    return keyed_rows(docs, F.struct("*").alias("doc"))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``(node, label)`` for every node of ``edges (a, b)``: the least node of its component.

    Alternates two star rounds (each node hands its greater, then its lesser
    neighbours to the least one it knows) until every edge ends in the least node.
    Each round is an aggregate with map-side combine and a join that Spark can
    split, so a node with a third of all edges is no single task; rounds grow with
    the logarithm of the longest path. Each round is a written table. No node or
    edge reaches the driver, only a count and a checksum of the edges a round.
    """
    spark = edges.sparkSession
    stars = written(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(rounds):
        now = stars.agg(F.count("*"), F.expr("bit_xor(xxhash64(v, m))")).first()
        if now == seen:
            break
        seen = now
        both = stars.union(stars.select(F.col("m").alias("v"), F.col("v").alias("m")))
        # Stored first: a join with an aggregate is one that Spark can't split.
        least = both.groupBy("v").agg(F.min("m").alias("least"))
        least = written(least.select("v", F.least("least", "v").alias("least")), "least")
        large = written(
            both.join(least, "v")
            .where(F.col("m") > F.col("v"))
            .select(F.col("m").alias("v"), F.col("least").alias("m"))
            .distinct(),
            "large-star",
        )
        lesser = written(large.groupBy("v").agg(F.min("m").alias("least")), "lesser")
        stars = written(
            large.join(lesser, "v")
            .select(F.col("m").alias("v"), F.col("least").alias("m"))
            .union(lesser.select("v", F.col("least").alias("m")))
            .where(F.col("v") != F.col("m"))
            .distinct(),
            "small-star",
        )
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    roots = stars.select(F.col("m").alias("node"), F.col("m").alias("label")).distinct()
    return written(
        stars.select(F.col("v").alias("node"), F.col("m").alias("label")).union(roots), "labels"
    )
