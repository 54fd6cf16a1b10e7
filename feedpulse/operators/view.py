"""The read view of stored posts, and the display form of single posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedpulse.functions.labels import label_class, label_or_unknown, two_decimals
from feedpulse.functions.text import blank_if_null, preview
from feedpulse.functions.times import epoch_to_ts, time_text

MISSING_SCORE = 0.5
TITLE_PREVIEW = 80
TEXT_PREVIEW = 500


def posts_view(df: DataFrame) -> DataFrame:
    """The eight columns the panels read.

    Blank instead of null texts, 0.5 for a missing score, upper-case labels, and
    no time where it is 0. ``created_at`` may be epoch seconds or a timestamp.
    """
    if isinstance(df.schema["created_at"].dataType, T.NumericType):
        created_at = epoch_to_ts(F.col("created_at"))
    else:
        created_at = F.nullif(F.col("created_at").cast("timestamp"), F.timestamp_seconds(F.lit(0)))
    return df.select(
        "id",
        created_at.alias("created_at"),
        "subreddit",
        blank_if_null(F.col("title")).alias("title"),
        blank_if_null(F.col("text")).alias("text"),
        "type",
        F.upper("sentiment_label").alias("sentiment_label"),
        F.coalesce(F.col("sentiment_score").cast("double"), F.lit(MISSING_SCORE)).alias(
            "sentiment_score"
        ),
    )


def post_cards(df: DataFrame) -> DataFrame:
    """One display row per post: previews, time text, label and its colour."""
    return df.select(
        "id",
        preview(F.col("title"), TITLE_PREVIEW).alias("title"),
        "subreddit",
        time_text(F.col("created_at")).alias("posted"),
        label_or_unknown(F.col("sentiment_label")).alias("sentiment"),
        label_class(F.col("sentiment_label")).alias("color"),
        F.col("sentiment_score").alias("score"),
        two_decimals(F.col("sentiment_score")).alias("score_text"),
        preview(F.col("text"), TEXT_PREVIEW).alias("content"),
    )


def recent_posts(df: DataFrame, k: int = 10) -> DataFrame:
    """Cards of the latest ``k`` posts, undated ones last, ties by id.

    Each task keeps its own best ``k`` rows; previews are cut for the winners.
    """
    return post_cards(df.orderBy(F.desc_nulls_last("created_at"), "id").limit(k))


def raw_sample(df: DataFrame, n: int = 3, order: str | None = None) -> DataFrame:
    """First rows for a look at the data; give ``order`` for the same rows each time."""
    return (df.orderBy(order) if order else df).limit(n)


def table_columns(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def schema_report(df: DataFrame, required: list[str], counts: bool = False) -> DataFrame:
    """One row per column: its type and whether it is required, extra or missing.

    The names come from the schema, so nothing is read. ``counts`` adds the
    number of filled rows per column, from one aggregate over one scan.
    """
    types = dict(table_columns(df))
    missing = [c for c in required if c not in types]
    if counts:
        base = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in types])
    else:
        base = df.sparkSession.range(1)

    def line(name: str, status: str, kind: str | None) -> Column:
        fields = [
            F.lit(name).alias("column_name"),
            F.lit(kind).cast("string").alias("type"),
            F.lit(status).alias("status"),
        ]
        if counts:
            filled = F.col(f"`{name}`") if name in types else F.lit(0)
            fields.append(filled.cast("long").alias("filled"))
        return F.struct(*fields)

    lines = [line(c, "present" if c in required else "extra", t) for c, t in types.items()]
    lines += [line(c, "missing", None) for c in missing]
    return base.select(F.inline(F.array(*lines)))
