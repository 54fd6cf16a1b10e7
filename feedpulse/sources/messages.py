"""Posts as JSON messages: writing, decoding, parsing, bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedpulse.functions.text import has_text
from feedpulse.functions.times import seconds_to_ts, ts_to_epoch
from feedpulse.schema import POST_COLUMNS, WIRE_SCHEMA

# Where a message stood in its topic; these order re-sent posts.
POSITION_COLUMNS = ["timestamp", "partition", "offset"]


def to_messages(df: DataFrame) -> DataFrame:
    """Posts as ``key`` (the id) and ``value`` (one JSON object, nulls spelled out).

    Keying by id keeps all versions of a post in one topic partition, in order.
    """
    created_at = F.col("created_at")
    if isinstance(df.schema["created_at"].dataType, (T.TimestampType, T.TimestampNTZType)):
        created_at = ts_to_epoch(created_at)
    fields = [
        (created_at if c == "created_at" else F.col(c)).alias(c) for c in POST_COLUMNS
    ]
    return df.select(
        F.col("id").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def write_messages(df: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Posts to a topic, or to text files with one message per line.

    Kafka takes ``topic`` and ``kafka.bootstrap.servers`` as options; files take
    ``path``.
    """
    messages = to_messages(df)
    if fmt != "kafka":
        messages = messages.select("value")
    messages.write.format(fmt).options(**options).mode("append").save()


def decode_kafka(df: DataFrame) -> DataFrame:
    """Key and value as strings; topic positions are kept where the source has them."""
    strings = [F.col(c).cast("string").alias(c) for c in ("key", "value") if c in df.columns]
    return df.select(*strings, *[c for c in POSITION_COLUMNS if c in df.columns])


def parse_json(
    df: DataFrame, schema: T.StructType, value: str = "value", corrupt: str = "_corrupt"
) -> DataFrame:
    """``value`` decoded into the columns of ``schema``.

    Text that is not such an object gives nulls and is copied to ``corrupt``.
    """
    others = [c for c in df.columns if c not in schema.fieldNames()]
    with_corrupt = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    data = F.from_json(value, with_corrupt, {"columnNameOfCorruptRecord": corrupt})
    return df.withColumn("_data", data).select(*others, "_data.*")


def parse_posts(df: DataFrame, schema: T.StructType = WIRE_SCHEMA) -> DataFrame:
    """Messages as posts with a timestamp; the message itself stays in ``value``.

    Whole and fractional seconds both parse; a time out of range becomes null.
    """
    return parse_json(df, schema).withColumn("created_at", seconds_to_ts(F.col("created_at")))


def require_key(df: DataFrame, key: str = "id") -> DataFrame:
    return df.where(F.col(key).isNotNull())


def split_valid(
    df: DataFrame, key: str = "id", value: str = "value", corrupt: str = "_corrupt"
) -> tuple[DataFrame, DataFrame]:
    """Parsed rows with a key, and the others as dead letters with the reason.

    The reason is ``empty``, ``malformed`` (not a whole JSON object) or
    ``no_key``. Input columns that are not part of the post stay with both.
    """
    reason = (
        F.when(~has_text(F.col(value)), "empty")
        .when(F.col(corrupt).isNotNull(), "malformed")
        .otherwise("no_key")
    )
    post = {f.name for f in WIRE_SCHEMA.fields} | {key, corrupt}
    kept = [c for c in df.columns if c not in post]
    dead = df.where(F.col(key).isNull()).select(*kept, reason.alias("reason"))
    return require_key(df, key).drop(corrupt), dead
