"""An index of a feed's files, and reads that open only the files they need.

For each file of the table the index has its number of rows, the least and greatest id
and time, the first and last id in the order ids are counted up in, and a bloom filter of
each indexed column, kept as the 64-bit words of it that are not zero. It is made of the folders that are new, in one pass over their narrow
columns, and committed like any table; folders that are not indexed yet are always read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.operators.view import posts_view
from feedpulse.schema import TABLE_SCHEMA
from feedpulse.sources.commits import CommitLog, Snapshot, committed_rows, hour_of
from feedpulse.sources.table import latest_posts, scan_posts

INDEXED = ("id", "subreddit")
#: Bits a row, and how many of them a value sets: one file in a hundred is opened in vain.
BITS, PROBES = 10, 7

_FACTS = (
    "file string, folder string, rows long, words long, least_id string, greatest_id string, "
    "oldest timestamp, newest timestamp, undated long, first_id struct<length int, id string>, "
    "last_id struct<length int, id string>, part string"
)
_BLOOM = "file string, folder string, column string, words long, word long, bits long, part string"


def _probes(value: Column, words: Column) -> Column:
    """``(word, mask)`` of the bits that ``value`` sets in a filter of ``words``."""
    places = [F.pmod(F.xxhash64(F.lit(k), value), words * 64) for k in range(PROBES)]
    return F.array(
        *[
            F.struct(
                F.floor(p / 64).cast("long").alias("word"),
                F.expr("1L").alias("one"),
                (p % 64).cast("int").alias("shift"),
            )
            for p in places
        ]
    )


def _exploded(df: DataFrame, value: str, *columns: str) -> DataFrame:
    """A row per probe of ``value``: ``columns``, ``words``, ``probe``, ``word``, ``mask``."""
    at = df.select(*columns, "words", F.posexplode(_probes(F.col(value), F.col("words"))))
    return at.select(
        *columns,
        "words",
        F.col("pos").alias("probe"),
        F.col("col.word").alias("word"),
        F.call_function("shiftleft", F.col("col.one"), F.col("col.shift")).alias("mask"),
    )


def _counted(value: Column) -> Column:
    """Orders ids as they are counted up, in any base: the shorter first, then by text.

    By text alone a file with 99 and 100 spans nearly all ids, and the filter, asked for
    many of them, lets some pass.
    """
    return F.struct(F.length(value).alias("length"), value.alias("id"))


def _file_of(base: str) -> Column:
    """The name of a row's file below the feed's folder."""
    return F.regexp_extract("_metadata.file_path", "/(posts/[^/]+/.*)$", 1)


def index_files(spark: SparkSession, base: str) -> int:
    """Indexes the folders of posts that are not yet; returns their number.

    Index rows of folders that were compacted away are left behind and not read.
    """
    log = CommitLog(spark, base)
    state = log.snapshot()
    done = {r[0] for r in _facts(spark, base, state).select("folder").distinct().collect()}
    new = sorted(set(state.of("posts")) - done)
    if not new:
        return 0
    stored = spark.read.schema(TABLE_SCHEMA).option("basePath", f"{log.base}/posts")
    rows = stored.parquet(*log.paths(new)).select(
        *INDEXED, "created_at", _file_of(log.base).alias("file")
    )
    name = f"part={uuid.uuid4().hex}"
    facts = rows.groupBy("file").agg(
        F.count("*").alias("rows"),
        F.min("id").alias("least_id"),
        F.max("id").alias("greatest_id"),
        F.min(F.when(F.col("id").isNotNull(), _counted(F.col("id")))).alias("first_id"),
        F.max(F.when(F.col("id").isNotNull(), _counted(F.col("id")))).alias("last_id"),
        F.min("created_at").alias("oldest"),
        F.max("created_at").alias("newest"),
        F.count_if(F.col("created_at").isNull()).alias("undated"),
    )
    # A power of two, so that there are few sizes to probe for.
    size = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("rows") * BITS / 64, F.lit(1)))))
    facts = facts.withColumns(
        {"words": size.cast("long"), "folder": F.regexp_extract("file", "^(posts/[^/]+)/", 1)}
    )
    facts.write.mode("overwrite").parquet(f"{log.base}/lookup/{name}")
    sizes = spark.read.parquet(f"{log.base}/lookup/{name}").select("file", "folder", "words")
    values = rows.select("file", F.explode(F.create_map(*[x for c in INDEXED for x in (F.lit(c), F.col(c))])))
    values = values.where("value IS NOT NULL").distinct().toDF("file", "column", "value")
    bits = _exploded(values.join(sizes, "file"), "value", "file", "folder", "column")
    (
        bits.groupBy("file", "folder", "column", "words", "word")
        .agg(F.bit_or("mask").alias("bits"))
        .write.mode("overwrite")
        .parquet(f"{log.base}/lookup_bits/{name}")
    )
    hour = hour_of(None)
    log.commit({f"lookup/{name}": hour, f"lookup_bits/{name}": hour})
    return len(new)


def _facts(spark: SparkSession, base: str, state: Snapshot) -> DataFrame:
    """Facts of the files that count in ``state``."""
    facts = committed_rows(spark, f"{base}/lookup", state.number, _FACTS)
    return _live(spark, facts if facts is not None else spark.createDataFrame([], _FACTS), state)


def _live(spark: SparkSession, rows: DataFrame, state: Snapshot) -> DataFrame:
    folders = spark.createDataFrame([(f,) for f in state.of("posts")], "folder string")
    return rows.join(folders, "folder", "left_semi")


def files_with(
    spark: SparkSession, base: str, values: DataFrame, column: str = "id", as_of: int | None = None
) -> list[str]:
    """Files that can hold a value of ``values (value)``, and folders not indexed yet."""
    state = CommitLog(spark, base).snapshot(as_of)
    facts = _facts(spark, base, state)
    known = {(r[0], r[1]) for r in facts.select("folder", "words").distinct().collect()}
    unknown = set(state.of("posts")) - {folder for folder, _ in known}
    sizes = sorted({words for _, words in known})
    if not sizes:
        return sorted(unknown)
    asked = values.distinct().select("value", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("words"))
    asked = asked.withColumn("words", F.col("words").cast("long"))
    bloom = committed_rows(spark, f"{base}/lookup_bits", state.number, _BLOOM)
    bloom = _live(spark, bloom, state).where(F.col("column") == column)
    met = (
        bloom.join(_exploded(asked, "value", "value"), ["words", "word"])
        .where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        .groupBy("file", "value")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") == PROBES)
    )
    if column == "id":
        value = F.col("value")
        # An index of before has no first and last id.
        inside = F.coalesce(_counted(value).between(F.col("first_id"), F.col("last_id")), F.lit(True))
        met = met.join(
            facts.select("file", "least_id", "greatest_id", "first_id", "last_id"), "file"
        ).where(value.between(F.col("least_id"), F.col("greatest_id")) & inside)
    return sorted(unknown | {r[0] for r in met.select("file").distinct().collect()})


def _rows_of(spark: SparkSession, base: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], TABLE_SCHEMA)
    reader = spark.read.schema(TABLE_SCHEMA).option("basePath", f"{base}/posts")
    return reader.parquet(*[f"{base}/{n}" for n in names])


def _kept(rows: DataFrame, state: Snapshot) -> DataFrame:
    if not state.dropped_before:
        return rows
    return rows.where(F.col("dt") >= F.lit(state.dropped_before).cast("date"))


def lookup_posts(
    spark: SparkSession, base: str, ids: list[str] | DataFrame, as_of: int | None = None
) -> DataFrame:
    """The newest version of each of ``ids``, from the files that can hold it.

    ``ids`` is a list, or a table with a column ``id``; Spark picks the joins by size.
    Where a feed has no index all files are read. Null ids find nothing.
    """
    if isinstance(ids, list):
        ids = spark.createDataFrame([(i,) for i in ids], "id string")
    asked = ids.select(F.col("id").cast("string").alias("value"))
    names = files_with(spark, base, asked, as_of=as_of)
    state = CommitLog(spark, base).snapshot(as_of)
    rows = _kept(_rows_of(spark, base, names), state)
    return latest_posts(rows.join(asked.select(F.col("value").alias("id")), "id", "left_semi").select(rows.columns))


def posts_of(spark: SparkSession, base: str, communities: list[str]) -> DataFrame:
    """The posts that are in one of ``communities`` in their newest version.

    Files with the communities name the ids; a post that has moved on to another
    community since is looked up and left out.
    """
    asked = spark.createDataFrame([(c,) for c in communities], "value string")
    names = files_with(spark, base, asked, "subreddit")
    state = CommitLog(spark, base).snapshot()
    mine = F.col("subreddit").isin(communities)
    ids = _kept(_rows_of(spark, base, names), state).where(mine).select("id").distinct()
    return lookup_posts(spark, base, ids).where(mine)


def _by_newest(facts: DataFrame) -> Iterator[tuple]:
    rows = facts.where("newest IS NOT NULL").orderBy(F.desc("newest"), "file")
    return rows.select("file", "newest").toLocalIterator()


def newest_posts(spark: SparkSession, base: str, k: int = 10, files: list | None = None) -> DataFrame:
    """The latest ``k`` posts, ties by id, as :func:`recent_posts` orders them.

    Files are opened by their newest post, and no more of them once ``k`` posts are newer
    than any in those left. What was found is looked up, for a newer version may say
    another time. ``files`` is given the names of the files opened. Where fewer than ``k``
    posts have a time, the whole table is read.
    """
    state = CommitLog(spark, base).snapshot()
    facts = _facts(spark, base, state)
    indexed = {r[0] for r in facts.select("folder").distinct().collect()}
    opened, left = sorted(set(state.of("posts")) - indexed), _by_newest(facts)
    order = [F.desc("created_at"), "id"]
    following, step, n = next(left, None), 2, 4 * k
    while True:
        for _ in range(step):
            if following is not None:
                opened.append(following[0])
                following = next(left, None)
        step *= 2
        dated = _kept(_rows_of(spark, base, opened), state).where("created_at IS NOT NULL")
        while True:
            head = dated.select("id", "created_at").orderBy(*order).limit(n).collect()
            bounds = [following[1]] if following else []
            if len(head) == n:
                bounds.append(head[-1].created_at)
            found = lookup_posts(spark, base, sorted({r.id for r in head}))
            if bounds:
                found = found.where(F.col("created_at") > F.lit(max(bounds)))
            ids = [r[0] for r in found.where("created_at IS NOT NULL").orderBy(*order).limit(k).select("id").collect()]
            if len(ids) == k:
                if files is not None:
                    files += opened
                return posts_view(lookup_posts(spark, base, ids))
            if len(head) < n or (following and max(bounds) == following[1]):
                break
            n *= 4
        if following is None:
            if files is not None:
                files += opened
            return scan_posts(spark, f"{base}/posts", limit=k)
