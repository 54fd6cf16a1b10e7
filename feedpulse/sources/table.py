"""The table of scored posts: plain Parquet, keyed by post id.

A batch owns the folder ``batch_id=<n>``, with one folder per insertion day
below it. Writing a batch again replaces its folder, so a replay changes
nothing. Readers keep the newest version of each id.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedpulse.functions.times import ts_literal
from feedpulse.operators.view import posts_view
from feedpulse.schema import (
    POST_COLUMNS,
    TABLE_DATA_COLUMNS,
    TABLE_PARTITIONS,
    TABLE_SCHEMA,
)
from feedpulse.sources.commits import committed, committed_rows, files
from feedpulse.sources.messages import POSITION_COLUMNS

RETENTION_DAYS = 30
COMPACTED = -1

# Lookups by id and community skip compacted files: by bloom filter (communities
# that repeat enough are looked up in their dictionary), the other columns by the
# value ranges that the sort order keeps narrow. A filter takes 64 KB at least, too
# much for the small files of a micro-batch.
LOOKUP_OPTIONS = {
    "parquet.bloom.filter.enabled#id": "true",
    "parquet.bloom.filter.enabled#subreddit": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def newest_in_batch(df: DataFrame) -> DataFrame:
    """One row per id of a batch: the last by topic position, else by time.

    ``max_by`` combines on the map side, so an id repeated through the batch
    does not pile up in one task. Equal positions are settled by the content.
    """
    order = [c for c in POSITION_COLUMNS if c in df.columns] or ["created_at"]
    newest = F.max_by(F.struct(*df.columns), F.struct(*order, *POST_COLUMNS))
    return df.groupBy("id").agg(newest.alias("_post")).select("_post.*")


def latest_per_key(df: DataFrame, key: str = "id", order: str = "version") -> DataFrame:
    """Rows with the highest ``order`` of their key; the pair must be unique.

    Rows without a key have no versions and all stay. ``max_by`` combines on the map
    side, so a key with a third of all rows sends one row from each task.
    """
    newest = F.max_by(F.struct(*df.columns), F.col(order)).alias("_row")
    keyed = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(newest)
    return keyed.select("_row.*").unionByName(df.where(F.col(key).isNull()))


def with_insertion_time(df: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else ts_literal(as_of)
    return df.withColumn("insertion_time", now)


def with_layout_columns(df: DataFrame) -> DataFrame:
    """Adds ``bucket``, the hour of the post, and ``dt``, the day of insertion."""
    return df.withColumns({"bucket": F.hour("created_at"), "dt": F.to_date("insertion_time")})


_CLUSTERING = ["dt", "subreddit", "bucket", "created_at", "id"]


def layout(df: DataFrame) -> DataFrame:
    """Rows ordered by community, hour, time and id."""
    return with_layout_columns(df).sortWithinPartitions(*_CLUSTERING)


def newest_layout(df: DataFrame, order: Column | str = "version", files: int | None = None) -> DataFrame:
    """The row with the highest ``order`` of each id, ordered as by :func:`layout` and in ranges.

    The ranges are cut by the same columns, which end with the unique id: a community with
    a third of all posts is cut into as many ranges as it needs. Finding the bounds takes
    one more read of the rows. Without ``files`` Spark sizes the ranges.

    The texts are moved once. Which row is the newest is found by narrow columns; a mark
    with the place of that row goes to the same range and comes to stand right before it,
    and rows that have no mark before them are left out there. Rows without an id all stay.
    """
    df = with_layout_columns(df)
    place = [*_CLUSTERING, "batch_id", "version"]
    newest = F.max_by(F.struct(*[c for c in place if c != "id"]), order).alias("_place")
    keyed = df.where(F.col("id").isNotNull())
    marks = keyed.groupBy("id").agg(newest).select("id", "_place.*", F.lit(True).alias("_mark"))
    rows = df.withColumn("_mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    rows = rows.repartitionByRange(*([files] if files else []), *_CLUSTERING)
    before = F.lag("_mark").over(Window.partitionBy(*place).orderBy(F.desc("_mark")))
    kept = rows.withColumn("_marked", before).where(
        ~F.col("_mark") & (F.col("_marked") | F.col("id").isNull())
    )
    return kept.select(df.columns).sortWithinPartitions(*_CLUSTERING)


def _write_folder(df: DataFrame, path: str, batch_id: int, **options: str) -> None:
    (
        df.select(*TABLE_DATA_COLUMNS, "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .options(**options)
        .partitionBy("dt")
        .parquet(f"{path}/batch_id={batch_id}")
    )


def upsert_posts(
    df: DataFrame, batch_id: int, path: str, as_of: datetime | Column | None = None
) -> None:
    """Writes scored posts, one per id, as version ``batch_id`` of those ids."""
    if batch_id < 0:
        raise ValueError("batch numbers start at 0; a negative one marks compacted rows")
    versioned = with_insertion_time(df, as_of).withColumn("version", F.lit(batch_id).cast("long"))
    _write_folder(layout(versioned), path, batch_id)


def read_versions(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """All stored rows, superseded ones included; none where nothing was stored.

    Where a job keeps a commit log next to the table, the rows of the last commit or of
    commit ``as_of``.
    """
    rows = committed_rows(spark, path, as_of, TABLE_SCHEMA)
    if rows is not None:
        return rows
    fs, folder = files(spark, path)
    if not fs.exists(folder):
        return spark.createDataFrame([], TABLE_SCHEMA)
    return spark.read.schema(TABLE_SCHEMA).parquet(path)


def _compacted_only(spark: SparkSession, path: str, as_of: int | None = None) -> bool:
    """Whether there is nothing but compacted rows, which are unique by id, told by folders.

    Spark does not know before it has read them that there are no later rows, and moves
    all texts to join them with none.
    """
    found = committed(spark, path, as_of)
    if found:
        names = {f.rpartition("/")[2] for f in found[1].of(path.rstrip("/").rpartition("/")[2])}
        return names == {f"batch_id={COMPACTED}"}
    fs, folder = files(spark, path)
    if not fs.exists(folder):
        return False
    inside, base = fs.listStatusIterator(folder), False
    while inside.hasNext():
        name = inside.next().getPath().getName()
        if "=" in name and name != f"batch_id={COMPACTED}":
            return False
        base = base or "=" in name
    return base


def next_version(spark: SparkSession, path: str) -> int:
    """The batch number from which a stream with a new checkpoint may go on."""
    found = committed(spark, path)
    if found:
        return found[1].last_batch + 1
    newest = read_versions(spark, path).agg(F.max("version")).first()[0]
    return 0 if newest is None else newest + 1


def latest_posts(versions: DataFrame) -> DataFrame:
    """The newest row of each id.

    Compacted rows are unique by id. They are the base and stay where they are read,
    unless a later batch has their id; only rows of later batches are aggregated.
    A batch replayed after a compaction has the version the compacted row kept; the
    replayed one wins then.
    """
    base = versions.where(F.col("batch_id") == COMPACTED)
    later = versions.where(F.col("batch_id") != COMPACTED)
    ids = later.select("id").where("id IS NOT NULL").distinct()
    return base.join(ids, "id", "left_anti").select(versions.columns).unionByName(
        latest_per_key(later)
    )


def scan_posts(
    spark: SparkSession,
    path: str,
    limit: int | None = None,
    since: datetime | None = None,
    retention_days: int | None = None,
    as_of: int | None = None,
) -> DataFrame:
    """The read view of the table, whole unless limited.

    ``since`` keeps posts created then or later, whenever they were stored.
    ``retention_days`` hides posts written longer ago. The limited rows are the
    newest, ties by id. ``as_of`` is a commit, for the table after it.
    """
    latest = read_versions(spark, path, as_of)
    if not _compacted_only(spark, path, as_of):
        latest = latest_posts(latest)
    if retention_days is not None:
        latest = retain(latest, retention_days)
    view = posts_view(latest)
    if since is not None:
        view = view.where(F.col("created_at") >= ts_literal(since))
    if limit is None:
        return view
    return view.orderBy(F.desc_nulls_last("created_at"), "id").limit(limit)


def ensure_table(spark: SparkSession, name: str, path: str) -> None:
    """Creates database, table and view where absent and registers new folders.

    ``name`` reads as one row per id; all versions are in ``<name>_versions``. Call
    it again to see batches written since.
    """
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLE_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name}_versions ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(TABLE_PARTITIONS)}) LOCATION '{path}'"
    )
    spark.sql(f"ALTER TABLE {name}_versions RECOVER PARTITIONS")
    all_columns = ", ".join(f"`{f.name}`" for f in TABLE_SCHEMA.fields)
    base, later = f"batch_id = {COMPACTED}", f"batch_id <> {COMPACTED}"
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS "
        f"SELECT {all_columns} FROM (SELECT * FROM {name}_versions WHERE {base}) AS base "
        f"LEFT ANTI JOIN (SELECT id AS again FROM {name}_versions WHERE {later}) ON id = again "
        "UNION ALL "
        f"SELECT row.* FROM (SELECT max_by(struct({all_columns}), version) AS row "
        f"FROM {name}_versions WHERE {later} AND id IS NOT NULL GROUP BY id) UNION ALL "
        f"SELECT {all_columns} FROM {name}_versions WHERE {later} AND id IS NULL"
    )


def _horizon(days: int, as_of: datetime | Column | None) -> Column:
    now = F.current_timestamp() if as_of is None else ts_literal(as_of)
    return now - F.make_dt_interval(F.lit(days))


def retain(
    df: DataFrame, days: int = RETENTION_DAYS, as_of: datetime | Column | None = None
) -> DataFrame:
    """Rows inserted within the last ``days``."""
    return df.where(F.col("insertion_time") > _horizon(days, as_of))


def drop_expired(
    spark: SparkSession,
    path: str,
    days: int = RETENTION_DAYS,
    as_of: datetime | None = None,
) -> int:
    """Deletes the day folders that hold expired rows only; returns their number.

    Works on folder names alone, one batch folder at a time, so the driver holds the
    days of one batch. Rows of the day in which the horizon falls stay until the
    next call and are hidden by :func:`retain`.

    Where a job keeps a commit log, the days go by one commit, from the table and from
    the rollup beside it, whose rows carry the day of the post they count; what is
    deleted afterwards has no reader any more.
    """
    last = spark.range(1).select(F.to_date(_horizon(days, as_of))).first()[0]
    found = committed(spark, path)
    tables = [path]
    if found:
        found[0].commit(dropped_before=last)
        tables.append(f"{found[0].base}/rollup")
    dropped = [0, 0]
    for k, table in enumerate(tables):
        fs, folder = files(spark, table)
        if not fs.exists(folder):
            continue
        batches = fs.listStatusIterator(folder)
        while batches.hasNext():
            batch = batches.next().getPath()
            if "=" not in batch.getName():
                continue
            inside = fs.listStatusIterator(batch)
            while inside.hasNext():
                day = inside.next().getPath()
                name, _, value = day.getName().partition("=")
                if name == "dt" and value[:1].isdigit() and date.fromisoformat(value) < last:
                    fs.delete(day, True)
                    dropped[k] += 1
    return dropped[0]


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    files: int | None = None,
) -> None:
    """Rewrites the newest versions as few, well-clustered files under ``target``.

    All days are rewritten, and ``target`` then holds what ``path`` held. The source
    is left as it is. Run it while the stream is stopped and start the stream on
    ``target`` afterwards: versions are kept, so later batches and a replayed last
    one still win.
    """
    # Any later row of an id replaces the compacted one, see latest_posts().
    order = F.struct(F.col("batch_id") != COMPACTED, "version")
    clustered = newest_layout(read_versions(spark, path), order, files)
    _write_folder(clustered, target, COMPACTED, **LOOKUP_OPTIONS)
