"""Compaction of a feed's tables in hour windows, beside the running jobs.

Jobs add folders every few seconds. When an insertion hour is over, what was added in it
is rewritten as one folder a table, and a commit puts it in place of the small ones. So
each row is rewritten once, the number of folders grows with hours, and a job that
commits meanwhile is in nobody's way.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.schema import TABLE_DATA_COLUMNS, TABLE_SCHEMA
from feedpulse.sources.commits import CommitLog, hour_of
from feedpulse.sources.table import LOOKUP_OPTIONS, newest_layout

#: Keys by which rows of a table add up; rows of the others are kept as they are.
_SUMMED = {
    "rollup": ["dt", "bucket", "subreddit", "sentiment_label"],
    "trend": ["late", "id", "created_at", "bucket", "subreddit", "sentiment_label", "sentiment_score"],
}


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; those that came to nothing are left out."""
    sums = rows.groupBy(*keys).agg(
        F.sum("posts").alias("posts"),
        F.sum("scored").alias("scored"),
        F.sum("score_sum").alias("score_sum"),
        F.min("first_post").alias("first_post"),
        F.max("last_post").alias("last_post"),
    )
    return sums.where((F.col("posts") != 0) | (F.col("scored") != 0))


def _rewrite(log: CommitLog, table: str, folders: list[str], dropped_before: str | None) -> str:
    """Writes the rows of ``folders`` as one folder; returns its name."""
    path, own = f"{log.base}/{table}", uuid.uuid4().int >> 66
    reader = log.spark.read
    if table == "posts":
        reader = reader.schema(TABLE_SCHEMA)
    if table in ("posts", *_SUMMED):
        reader = reader.option("basePath", path)
    rows = reader.parquet(*log.paths(folders))
    if dropped_before and "dt" in rows.columns:
        rows = rows.where(F.col("dt") >= F.lit(dropped_before).cast("date"))
    if table == "posts":
        # Negative, as for all compacted rows; -1 is that of a whole table.
        name = f"batch_id=-{own + 2}"
        newest = newest_layout(rows).select(*TABLE_DATA_COLUMNS, "dt")
        writer = newest.write.options(**LOOKUP_OPTIONS).partitionBy("dt")
    elif table in _SUMMED:
        name = f"part=window-{own}"
        keys = _SUMMED[table]
        writer = _summed(rows, keys).write.partitionBy(keys[0])
    else:
        name = f"batch_id=-{own + 2}"
        writer = rows.write
    writer.mode("overwrite").parquet(f"{path}/{name}")
    return f"{table}/{name}"


def compact_windows(spark: SparkSession, base: str, as_of: datetime | None = None) -> int:
    """Rewrites all hours of the feed at ``base`` that are over; returns the folders saved.

    ``as_of`` is the present, for tests. Of posts sent again within an hour the newest
    version stays; versions of other hours are told apart by readers as before. Run one
    at a time; the jobs may run on. Folders replaced stay on disk until
    :meth:`CommitLog.vacuum`, for readers that began before.
    """
    log = CommitLog(spark, base)
    state, now, saved = log.snapshot(), hour_of(as_of), 0
    windows = defaultdict(list)
    for folder, hour in state.folders.items():
        if hour < now:
            windows[folder.split("/", 1)[0], hour].append(folder)
    for (table, hour), folders in sorted(windows.items()):
        if len(folders) > 1:
            whole = _rewrite(log, table, sorted(folders), state.dropped_before)
            log.commit({whole: hour}, folders)
            saved += len(folders) - 1
    return saved
