"""Rollups kept current by stateful streams over the table of scored posts.

``run_rollup`` is a ledger by post id: its state holds what each id counts for now, so a
batch looks up the shares that its own ids are in and nothing else, however many batches
are stored.
``run_trend`` counts quarter hours of event time and writes each once it is over.

State is in RocksDB and goes to the checkpoint as changes. Both commit to the log of the
feed, next to the scoring job.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feedpulse.functions.times import QUARTER, floor_ts
from feedpulse.operators.metrics import rollup_posts
from feedpulse.operators.view import MISSING_SCORE
from feedpulse.schema import TABLE_DATA_COLUMNS, TABLE_SCHEMA
from feedpulse.sources.commits import CommitLog, committed_rows, files, hour_of, stream_id
from feedpulse.sources.table import RETENTION_DAYS

#: Days that the ledger remembers a post for longer than the table keeps it. Expired days
#: are to be dropped within that time.
SPARE_DAYS = 7

#: Parts that the ids of the ledger are dealt into; one is a key of the state. Asking for a
#: key costs as much as some hundred ids in one. A checkpoint is bound to the number.
SHARES = 1 << 13

_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: What an id counts for; ``micros`` is the time of the post, ``day`` that of its insertion
#: as days since 1970. The ledger holds it as JSON and never looks inside.
_POST = "micros long, subreddit string, sentiment_label string, sentiment_score double, day int"
_CHANGE = "post string, posts long"
_ROLLUP = (
    "bucket timestamp, subreddit string, sentiment_label string, posts long, scored long, "
    "score_sum double, first_post timestamp, last_post timestamp, part string, dt date"
)
_COUNTED = (
    "late boolean, id string, created_at timestamp, bucket timestamp, subreddit string, "
    "sentiment_label string, sentiment_score double, posts long, scored long, "
    "score_sum double, first_post timestamp, last_post timestamp"
)
#: Times are microseconds inside a processor: executors give those in state back with a
#: time zone, those in rows without, and the two can't be compared.
_COUNTED_MICROS = _COUNTED.replace(" timestamp", " long")


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


_DAY = 86_400_000

#: Maker of rows with these columns.
_counted = Row(*_names(_COUNTED))


@contextmanager
def _settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings that a query takes over when it starts; the caller's come back."""
    conf = _ROCKSDB | {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


class PostLedger(StatefulProcessor):
    """By share of the ids: what each id counts for. Puts out what newer versions change.

    A version that is known and did not change gives nothing, so files that come again,
    replayed or compacted, count once. A version that is older than the known one is
    superseded already. Written again with other content, a version replaces itself.

    The state of a share is one JSON object, by id: the day it was put there, the version
    and the post. Ids put there too long ago go when their share is next asked for, or
    with it.
    """

    def __init__(self, days: int):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.now = handle.getValueState("now", "posts string", self.days * _DAY)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest: dict[str, tuple[int, str]] = {}
        for part in rows:
            for id, version, post in zip(*(part[c].tolist() for c in ("id", "version", "post"))):
                if id not in newest or version >= newest[id][0]:
                    newest[id] = (version, post)
        today = timerValues.getCurrentProcessingTimeInMs() // _DAY
        stored = self.now.get()
        held = json.loads(stored[0]) if stored else {}
        held = {id: entry for id, entry in held.items() if entry[0] >= today - self.days}
        posts, signs = [], []
        for id, (version, post) in newest.items():
            _, known, old = held.get(id, (None, None, None))
            if known is not None and (known > version or (known == version and old == post)):
                continue
            held[id] = (today, version, post)
            if known is not None:
                posts.append(old)
                signs.append(-1)
            posts.append(post)
            signs.append(1)
        if posts:
            self.now.update((json.dumps(held, separators=(",", ":")),))
            yield pd.DataFrame({"post": posts, "posts": signs})

    def close(self) -> None:
        pass


def _begins(ends_ms: int) -> int:
    """The microsecond at which the quarter hour begins that ends at ``ends_ms``."""
    return (ends_ms - 15 * 60_000) * 1000


class QuarterHours(StatefulProcessor):
    """By quarter hour, community and label: counts until the watermark is past its end.

    Then the counts are put out, once. A post that comes later is put out as it is and
    marked late: it is in neither a count of before nor one to come.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState(
            "counts",
            "posts long, scored long, score_sum double, first_post long, last_post long",
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        over = timerValues.getCurrentWatermarkInMs()
        held = self.counts.get() if self.counts.exists() else None
        known = held is not None
        for row in rows:
            if row.ends_ms <= over:
                yield _counted(
                    True, row.id, row.micros, _begins(row.ends_ms), row.subreddit, row.sentiment_label,
                    row.sentiment_score, 1, int(row.sentiment_score is not None),
                    row.sentiment_score or 0.0, row.micros, row.micros,
                )
                continue
            ends, time, score = row.ends_ms, row.micros, row.sentiment_score
            if held is None:
                held = (0, 0, 0.0, time, time)
            held = (
                held[0] + 1,
                held[1] + (score is not None),
                held[2] + (score or 0.0),
                min(held[3], time),
                max(held[4], time),
            )
        if held is not None:
            if not known:
                self.handle.registerTimer(ends)
            self.counts.update(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        ends, community, label, _ = key
        counts = tuple(self.counts.get())
        self.counts.clear()
        yield _counted(False, None, None, _begins(ends), community, label, None, *counts)

    def close(self) -> None:
        pass


def _stored_stream(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    """The files of the table of the feed at ``path`` as a stream, in the read view's terms."""
    fs, folder = files(spark, f"{path}/posts")
    fs.mkdirs(folder)
    fields = [f for f in TABLE_SCHEMA.fields if f.name in TABLE_DATA_COLUMNS]
    reader = spark.readStream.schema(type(TABLE_SCHEMA)(fields)).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(f"{path}/posts")
        # Compacted files hold what came before.
        .where(~F.contains("_metadata.file_path", F.lit("/batch_id=-")) & F.col("id").isNotNull())
        .select(
            "id",
            F.nullif(F.col("created_at"), F.timestamp_seconds(F.lit(0))).alias("created_at"),
            "subreddit",
            F.upper("sentiment_label").alias("sentiment_label"),
            F.coalesce("sentiment_score", F.lit(MISSING_SCORE)).alias("sentiment_score"),
            "version",
            F.to_date("insertion_time").alias("dt"),
        )
    )


def run_rollup(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    days: int = RETENTION_DAYS,
    max_files: int | None = None,
) -> StreamingQuery:
    """Keeps the rollup of the feed at ``path`` equal to its table.

    Each batch reads the files that came since the last one. A post that was sent again
    takes back what it counted for, on the day its old row was inserted; rollup rows
    carry that day, so :func:`drop_expired` takes the days of both off together, and a
    post that comes again after its old row has expired counts once.

    State of an id is dropped ``SPARE_DAYS`` after its row may be. A query with a new
    checkpoint starts over and replaces the rollup with its first batch: that is how to
    rebuild one, for instance after a batch was stored but given up for good.
    """
    posts = _stored_stream(spark, path, max_files)
    numbered = posts.select(
        F.pmod(F.xxhash64("id"), F.lit(SHARES)).alias("share"),
        "id",
        "version",
        F.to_json(
            F.struct(
                F.unix_micros("created_at").alias("micros"),
                "subreddit",
                "sentiment_label",
                "sentiment_score",
                F.unix_date("dt").alias("day"),
            )
        ).alias("post"),
    )
    changes = numbered.groupBy("share").transformWithStateInPandas(
        PostLedger(days + SPARE_DAYS), _CHANGE, "Update", "ProcessingTime"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        log, stream = CommitLog(own, path), stream_id(own)
        state = log.snapshot()
        if state.streams.get(stream, -1) >= batch_id:
            return
        part = f"rollup/part={stream}-{batch_id}"
        time = F.timestamp_micros("micros")
        changed = batch.select(F.from_json("post", _POST).alias("post"), "posts")
        measures = changed.select("post.*", "posts").select(
            F.date_from_unix_date("day").alias("dt"),
            time.alias("bucket"),
            "subreddit",
            "sentiment_label",
            "posts",
            F.col("posts").alias("scored"),
            (F.col("posts") * F.col("sentiment_score")).alias("score_sum"),
            time.alias("first_post"),
            time.alias("last_post"),
        )
        _rollup_by_day(measures).write.mode("overwrite").partitionBy("dt").parquet(f"{path}/{part}")
        replaced = [] if stream in state.streams else list(state.of("rollup"))
        log.commit({part: hour_of(None)}, replaced, stream, batch_id)

    # A batch without data has nothing to change, and would never be the last one.
    with _settings(spark, spark__sql__streaming__noDataMicroBatches__enabled="false"):
        return (
            changes.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"}))
            .start()
        )


def _rollup_by_day(measures: DataFrame) -> DataFrame:
    """As :func:`rollup_posts`, within each insertion day."""
    quarter = floor_ts(F.col("bucket"), QUARTER).alias("bucket")
    return measures.groupBy("dt", quarter, "subreddit", "sentiment_label").agg(
        F.sum("posts").alias("posts"),
        F.sum("scored").alias("scored"),
        F.sum("score_sum").alias("score_sum"),
        F.min("first_post").alias("first_post"),
        F.max("last_post").alias("last_post"),
    )


def read_rollup(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """The rollup at ``path``, ready for any panel; groups without posts are gone.

    ``as_of`` is a commit of the feed, for the state after it.
    """
    rows = committed_rows(spark, path, as_of, _ROLLUP)
    rows = spark.read.parquet(path) if rows is None else rows
    return rollup_posts(rows).where(F.col("posts") > 0)


def run_trend(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    delay: str = "1 hour",
    salts: int = 16,
    trigger: dict | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Counts the quarter hours of the feed at ``path``; for posts that are sent once.

    A quarter hour is over when a post was seen that is ``delay`` later than its end. Its
    counts are then written, never to change. Posts for a quarter hour that
    is over are kept apart as late. So each dated post is in one of the two or still in
    state. :func:`read_trend` and :func:`read_late` read them. Built-in window aggregates drop late rows without a trace; hence a processor
    of its own. ``salts`` spreads a quarter hour of one community over tasks.
    """
    bucket = floor_ts(F.col("created_at"), QUARTER)
    posts = (
        _stored_stream(spark, path, max_files)
        .where("created_at IS NOT NULL")
        .withWatermark("created_at", delay)
        .select(
            "id",
            # A new column: Spark drops late rows by a column that has the watermark.
            F.unix_micros("created_at").alias("micros"),
            (F.unix_millis(bucket.cast("timestamp")) + 15 * 60_000).alias("ends_ms"),
            "subreddit",
            "sentiment_label",
            "sentiment_score",
            F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"),
        )
    )
    counted = posts.groupBy("ends_ms", "subreddit", "sentiment_label", "salt").transformWithState(
        QuarterHours(), _COUNTED_MICROS, "Append", "EventTime"
    )
    times = ["created_at", "bucket", "first_post", "last_post"]
    counted = counted.withColumns({c: F.timestamp_micros(c) for c in times})

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        log, stream = CommitLog(own, path), stream_id(own)
        if log.snapshot().streams.get(stream, -1) >= batch_id:
            return
        part = f"trend/part={stream}-{batch_id}"
        # One pass, as the state is gone through again for each.
        batch.write.mode("overwrite").partitionBy("late").parquet(f"{path}/{part}")
        log.commit({part: hour_of(None)}, None, stream, batch_id)

    with _settings(spark):
        return (
            counted.writeStream.foreachBatch(write)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"}))
            .start()
        )


def _trend_rows(spark: SparkSession, path: str, as_of: int | None) -> DataFrame:
    rows = committed_rows(spark, f"{path}/trend", as_of, f"{_COUNTED}, part string")
    return spark.createDataFrame([], f"{_COUNTED}, part string") if rows is None else rows


def read_trend(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """The quarter hours of the feed at ``path`` that are over, as a rollup."""
    return rollup_posts(_trend_rows(spark, path, as_of).where("NOT late"))


def read_late(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """The posts that came when their quarter hour was over."""
    return _trend_rows(spark, path, as_of).where("late").select(
        "id", "created_at", "subreddit", "sentiment_label", "sentiment_score"
    )
