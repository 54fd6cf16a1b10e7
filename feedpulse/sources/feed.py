"""The feed: reading posts as a stream, and the filters before scoring."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.functions.text import blank_if_null, combine_text, has_text, strip_ws
from feedpulse.functions.times import ts_literal
from feedpulse.operators.language import language_of
from feedpulse.schema import POST_COLUMNS
from feedpulse.sources.commits import files


def stream_options(
    fmt: str,
    starting: str = "earliest",
    max_per_batch: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Reader options for the format: offsets for Kafka, files for the rest.

    Offsets or files that are gone end the stream unless ``fail_on_data_loss`` is
    false, which skips them.
    """
    if fmt == "kafka":
        options = {
            "startingOffsets": starting,
            "failOnDataLoss": str(fail_on_data_loss).lower(),
        }
        if max_per_batch:
            options["maxOffsetsPerTrigger"] = str(max_per_batch)
        return options
    options = {"ignoreMissingFiles": str(not fail_on_data_loss).lower()}
    if max_per_batch:
        options["maxFilesPerTrigger"] = str(max_per_batch)
    return options


def read_posts_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    schema=None,
    starting: str = "earliest",
    max_per_batch: int | None = None,
    fail_on_data_loss: bool = True,
    marker: str | None = None,
    **options: str,
) -> DataFrame:
    """A stream of raw messages or rows.

    ``fmt="kafka"`` takes ``subscribe`` and ``kafka.bootstrap.servers``;
    ``"text"`` reads one message per line into ``value``; ``"json"`` and
    ``"parquet"`` need ``schema``.

    Files have no offsets, so ``starting="latest"`` there means files written from the
    first start on; older ones are not opened. The file ``marker`` keeps that moment, so
    that a stream that starts again goes on with what came while it was down. A moment,
    as ISO text, may be given instead. Files count by their time of modification: one
    that is moved in with an older time is not new. :func:`posts_since` filters by
    the time of posts.
    """
    reader = spark.readStream.format(fmt).options(
        **stream_options(fmt, starting, max_per_batch, fail_on_data_loss), **options
    )
    stream = (reader.schema(schema) if schema is not None else reader).load()
    if fmt == "kafka" or starting == "earliest":
        return stream
    if marker is None:
        raise ValueError('files need a marker to start from "latest" or a time')
    start = _first_start(spark, marker, starting)
    return stream.where(F.col("_metadata.file_modification_time") > ts_literal(start))


def _first_start(spark: SparkSession, marker: str, starting: str) -> datetime:
    """The moment that ``marker`` keeps; put there now if it has none."""
    fs, path = files(spark, marker)
    if not fs.exists(path):
        moment = datetime.now(timezone.utc) if starting == "latest" else datetime.fromisoformat(starting)
        out = fs.create(path, False)
        out.write(bytearray(moment.isoformat().encode()))
        out.close()
        return moment
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return datetime.fromisoformat(text)


def posts_since(df: DataFrame, start: datetime) -> DataFrame:
    """New posts only: those created at or after ``start``."""
    return df.where(F.col("created_at") >= ts_literal(start))


def posts_feed(df: DataFrame, communities: list[str] | DataFrame) -> DataFrame:
    """Posts of the named communities.

    A list becomes a filter that reaches the scan. A DataFrame with a
    ``subreddit`` column becomes a semi join, broadcast only under Spark's own
    size threshold.
    """
    if isinstance(communities, DataFrame):
        return df.join(communities.select("subreddit"), "subreddit", "left_semi").select(
            *df.columns
        )
    return df.where(F.col("subreddit").isin(list(communities)))


def strip_texts(df: DataFrame) -> DataFrame:
    """Title and body without surrounding whitespace; null becomes blank."""
    return df.withColumns(
        {c: strip_ws(blank_if_null(F.col(c))) for c in ("title", "text")}
    )


def drop_blank(df: DataFrame) -> DataFrame:
    """Posts with anything but whitespace in title or body."""
    return df.where(has_text(F.col("title")) | has_text(F.col("text")))


def to_post_record(df: DataFrame, type: str = "submission") -> DataFrame:
    """The six fields of a message; ``type`` is the same for all."""
    return df.withColumn("type", F.lit(type)).select(*POST_COLUMNS)


def clean_feed(
    df: DataFrame,
    communities: list[str] | DataFrame | None = None,
    language: str | None = "en",
    type: str = "submission",
) -> DataFrame:
    """Raw posts to records worth scoring.

    Cheap filters come first: community, then blanks, then the language of title
    and body together. All of it is per row, so it runs the same on a stream.
    Texts are stripped last, for the posts that are kept: neither the blank
    check nor the words that tell the language depend on the whitespace around.
    """
    if communities is not None:
        df = posts_feed(df, communities)
    df = drop_blank(df)
    if language is not None:
        both = combine_text(F.col("title"), F.col("text"))
        df = df.where(language_of(both) == language)
    return to_post_record(strip_texts(df), type)
