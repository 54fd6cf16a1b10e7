"""The streaming jobs: posts to messages, messages to scored posts, posts to rollups."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from feedpulse.operators.metrics import rollup_posts
from feedpulse.operators.scoring import LexiconScorer, Scorer, check_scorer, score_posts
from feedpulse.operators.view import posts_view
from feedpulse.schema import POST_COLUMNS
from feedpulse.sources.commits import CommitLog, committed_rows, hour_of, stream_id
from feedpulse.sources.feed import clean_feed
from feedpulse.sources.messages import decode_kafka, parse_posts, split_valid, to_messages
from feedpulse.sources.table import newest_in_batch, upsert_posts

log = logging.getLogger(__name__)


def _replace_folder(df: DataFrame, path: str, batch_id: int) -> None:
    """Side outputs follow the table's rule: a batch owns its folder.

    The number is also a column of the rows, which may move to another folder later.
    """
    numbered = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    numbered.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def batch_writer(
    path: str,
    scorer: Scorer | None = None,
    clean: bool = False,
    communities: list[str] | None = None,
    language: str | None = "en",
    scorer_partitions: int | None = None,
    first_batch: int = 0,
    as_of: datetime | None = None,
) -> Callable[[DataFrame, int], None]:
    """The function run on each micro-batch of messages.

    Under ``path`` it writes the folders ``posts``, ``batch_log`` and, where there are
    bad messages, ``dead_letters``, and last a commit, without which none of them is
    read: after a crash in between, readers see the state before. A batch that the
    stream committed before is not done again.

    Nothing is kept in memory: posts are parsed, reduced to one per id, scored and
    written in one pass, on which the rows are counted; bad messages are read again only
    if there are some. Of all rows the driver sees three counts. The reduction moves the
    batch once, which also spreads it over the tasks; ``scorer_partitions`` fixes
    their number for a slow model.

    Batch numbers are versions, and one stream owns ``path``. A stream that lost
    its checkpoint counts from 0 again, which is an error here;
    ``first_batch=next_version(...)`` makes it go on after what is stored. Called on a
    batch DataFrame, outside of a stream, a number that is stored is written anew.
    """
    scorer = scorer or LexiconScorer()

    def process_batch(batch: DataFrame, batch_id: int) -> None:
        batch_id += first_batch
        if batch.isEmpty():
            log.info("batch %s is empty", batch_id)
            return
        session = batch.sparkSession
        commits, stream = CommitLog(session, path), stream_id(session)
        state = commits.snapshot()
        own = [f"{t}/batch_id={batch_id}" for t in ("posts", "batch_log", "dead_letters")]
        stored = [f for f in own if f in state.folders]
        before = state.streams.get(stream)
        if stream and batch_id == before:
            log.info("batch %s was committed before", batch_id)
            return
        if stream and batch_id <= (state.last_batch if before is None else before):
            raise ValueError(f"{path} has batches up to {state.last_batch}: set first_batch to go on")
        if stored:
            commits.commit(remove=stored)
        read, written = Observation(), Observation()
        parsed = parse_posts(decode_kafka(batch).drop("key")).observe(
            read, F.count(F.lit(1)).alias("rows_in"), F.count("id").alias("rows_valid")
        )
        posts = newest_in_batch(split_valid(parsed)[0].drop("value")).select(*POST_COLUMNS)
        if clean:
            posts = clean_feed(posts, communities, language)
        if scorer_partitions:
            posts = posts.repartition(scorer_partitions, "id")
        scored = score_posts(posts, scorer).observe(written, F.count(F.lit(1)).alias("rows"))
        upsert_posts(scored, batch_id, f"{path}/posts", as_of)
        dead = read.get["rows_in"] - read.get["rows_valid"]
        if dead:
            unparsed = parse_posts(decode_kafka(batch).drop("key"))
            _replace_folder(split_valid(unparsed)[1], f"{path}/dead_letters", batch_id)
        counts = {
            "rows_in": read.get["rows_in"],
            "rows_valid": read.get["rows_valid"],
            "rows_dead": dead,
            "rows_written": written.get["rows"],
        }
        line = session.range(1).select(
            *[F.lit(n).cast("long").alias(c) for c, n in counts.items()],
            F.current_timestamp().alias("logged_at"),
        )
        _replace_folder(line.coalesce(1), f"{path}/batch_log", batch_id)
        hour = hour_of(as_of)
        commits.commit({f: hour for f in own[: 3 if dead else 2]}, None, stream, batch_id)

    return process_batch


def run_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    scorer: Scorer | None = None,
    trigger: dict | None = None,
    **batch_options,
) -> StreamingQuery:
    """Starts the job on a stream with a ``value`` column; the caller awaits it.

    ``checkpoint`` belongs to this query alone. The default trigger is a
    micro-batch every five seconds; ``{"availableNow": True}`` drains the source
    and stops.
    """
    scorer = scorer or LexiconScorer()
    check_scorer(messages.sparkSession, scorer)
    return (
        messages.writeStream.foreachBatch(batch_writer(path, scorer, **batch_options))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def run_feed(
    raw: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    trigger: dict | None = None,
    communities: list[str] | DataFrame | None = None,
    language: str | None = "en",
    **sink_options: str,
) -> StreamingQuery:
    """Raw posts, cleaned and filtered, as a stream of messages.

    The sink is a Kafka topic (``topic``, ``kafka.bootstrap.servers``) or, with
    ``fmt="text"`` and ``path``, files of one message per line.
    """
    messages = to_messages(clean_feed(raw, communities, language))
    if fmt != "kafka":
        messages = messages.select("value")
    return (
        messages.writeStream.format(fmt)
        .options(**sink_options)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def await_stream(query: StreamingQuery, timeout: float | None = None) -> None:
    """Waits for the query and stops it on the way out, error or not."""
    try:
        query.awaitTermination(timeout) if timeout else query.awaitTermination()
    finally:
        query.stop()


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """A side output (dead letters, batch log) over all committed batches."""
    rows = committed_rows(spark, path, folder_columns=False)
    return spark.read.parquet(path) if rows is None else rows


def refresh_rollups(
    posts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps a rollup table current from any stream of scored posts, each sent once.

    Each batch writes the rollup of its own rows, and readers add them up. Nothing is
    kept between batches, so the job has no state to outgrow, and a replayed batch
    replaces its own part. Where posts are re-sent use ``rollup.run_rollup``, which
    knows what a post counted for before.
    """

    def write_part(batch: DataFrame, batch_id: int) -> None:
        _replace_folder(rollup_posts(posts_view(batch)), path, batch_id)

    return (
        posts.writeStream.foreachBatch(write_part)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


PROGRESS = "event string, query string, batch_id long, rows long, rows_per_second double, millis long, error string, at timestamp"


class StreamReporter(StreamingQueryListener):
    """Logs the progress of a session's streams and appends it to a table.

    Every event is one row of the Parquet table at ``path``; read it with
    :func:`read_folder`.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.seen: set[str] = set()

    def wait_for(self, event: str, seconds: float = 30) -> bool:
        """Whether an event of this kind was written, waiting for the first one."""
        until = time.monotonic() + seconds
        while event not in self.seen and time.monotonic() < until:
            time.sleep(0.05)
        return event in self.seen

    def _report(self, **fields) -> None:
        log.info("%s", fields)
        row = {name.split()[0]: None for name in PROGRESS.split(", ")} | fields
        row["at"] = datetime.now()
        self.spark.createDataFrame([tuple(row.values())], PROGRESS).coalesce(1).write.mode(
            "append"
        ).parquet(self.path)
        self.seen.add(row["event"])

    def onQueryStarted(self, event) -> None:
        self._report(event="started", query=str(event.id))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self._report(
            event="progress",
            query=str(progress.id),
            batch_id=progress.batchId,
            rows=progress.numInputRows,
            rows_per_second=progress.processedRowsPerSecond,
            millis=progress.batchDuration,
        )

    def onQueryIdle(self, event) -> None:
        self._report(event="idle", query=str(event.id))

    def onQueryTerminated(self, event) -> None:
        self._report(event="terminated", query=str(event.id), error=event.exception)
