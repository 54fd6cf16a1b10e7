"""Exact dedup against a persistent digest index.

The index is a table with one row per distinct text, bucketed and sorted by
digest. New rows are digested, grouped by digest, and set against the index by a
sort-merge anti-join on the digest; what the index does not hold is appended. The
index side of that join is read as it lies, without shuffle or sort of old rows.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm.common import ROW, documents, keyed_documents, text_or_empty, written
from feedpulse.session import shared_folder

# The white space that does not count.
SPACES = " \t\n\x0b\x0c\r"


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text in UTF-8 without ASCII white space."""
    return F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""), 256)


class DigestIndex:
    """The digests seen so far, in a bucketed table at ``path``.

    ``buckets`` counts when the table is made; it should grow with the corpus
    that is to come, as each bucket is one task of later joins. An index that
    exists is opened with the number it was made with.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.path = path
        self.table = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} "
            "(digest STRING, keep_id BIGINT, group_size BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, groups: DataFrame, batch: str) -> None:
        """Appends the ``groups (digest, keep_id, group_size)`` whose digest is new."""
        new = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        (
            new.select("digest", "keep_id", "group_size", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )

    def close(self) -> None:
        """Takes the table out of the catalog; the index stays at its path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def digests(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None
) -> DataFrame:
    """``(row, doc_id, digest, n_points)`` of every row, written once; texts stay behind."""
    value = text_or_empty(text)
    return written(
        docs.select(
            (F.col(row) if row else F.monotonically_increasing_id()).alias(ROW),
            F.col(doc_id).cast("long").alias("doc_id"),
            text_digest(value).alias("digest"),
            F.length(value).alias("n_points"),
        ),
        "digests",
    )


def dedup_exact(
    docs: DataFrame,
    index: DigestIndex,
    text: str = "text",
    doc_id: str = "doc_id",
    batch: str | None = None,
    row: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its group, and whether it stays.

    Columns ``_llm_row, doc_id, keep_id, group_size, kept, text_sha256, known``.
    Of equal texts the row with most code points stays, then the least ``doc_id`` (null
    last), then the least row key, so that exactly one of rows that are the same in all
    columns stays. Null texts count as empty; all empty texts are equal. A digest that
    an earlier batch brought (``known``) keeps its old keeper, so no row of this
    batch stays for it. ``group_size`` counts the rows of the batch that brought
    the digest in. Null ids keep their rows. Other columns are not looked at, so
    their names may clash. An empty table gives an empty result.

    ``batch`` names the batch in the index: the same batch again, after a failure that
    left it there in part or whole, gives the same rows. Without a name each call is a
    batch of its own. ``row`` names a row key that is stored with ``docs``.

    Copies share a digest, and a third of all rows may be one text: groups are
    counted with map-side combine and stored, and rows join what is stored about their
    digest, in a sort-merge join of narrow rows that Spark splits where one is hot.
    """
    batch = batch or uuid.uuid4().hex
    rows = digests(docs, text, doc_id, row)
    best = F.struct(
        (-F.col("n_points")).alias("n"),
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("id"),
        F.col(ROW).alias("row"),
    )
    groups = written(
        rows.groupBy("digest")
        .agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
        .select(
            "digest",
            F.col("best.id").alias("keep_id"),
            F.col("best.row").alias("keep_row"),
            "group_size",
        ),
        "digest-groups",
    )
    old = index.rows().where(F.col("batch") != batch).select(
        "digest",
        F.col("keep_id").alias("old_id"),
        F.col("group_size").alias("old_size"),
        F.lit(True).alias("known"),
    )
    known = F.coalesce("known", F.lit(False))
    decided = written(
        groups.join(old.hint("merge"), "digest", "left").select(
            "digest",
            F.when(known, F.col("old_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(~known, F.col("keep_row")).alias("keep_row"),
            F.when(known, F.col("old_size")).otherwise(F.col("group_size")).alias("group_size"),
            known.alias("known"),
        ),
        "decided",
    )
    index.add(groups, batch)
    return rows.join(decided, "digest").select(
        ROW,
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col(ROW) == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "known",
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, shared_folder(spark, "digest-index"))
    found = dedup_exact(documents(spark, sf_dir), index)
    index.close()
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` that stay, with their columns."""
    index = DigestIndex(spark, shared_folder(spark, "digest-index"))
    rows = keyed_documents(docs)
    kept = dedup_exact(rows.select(ROW, "doc.doc_id", "doc.text"), index, row=ROW)
    index.close()
    return rows.join(kept.where("kept").select(ROW), ROW, "left_semi").select("doc.*")


OP6_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id) = 1 AS kept,
       h AS text_sha256
FROM d
"""
