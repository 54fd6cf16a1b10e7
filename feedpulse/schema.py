"""Column layouts: the message on the wire, the stored post and the read view."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the wire message. One JSON object per post. ``created_at`` is epoch seconds and is declared
# DOUBLE because API clients send both 1716500000 and 1716500000.0; a BIGINT
# field would turn the second form into NULL.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("created_at", T.DoubleType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
)

POST_COLUMNS = WIRE_SCHEMA.fieldNames()

# What a reader of the table works with. ``cleaned_text`` is left out: no panel
# reads it, and it is the second widest column.
VIEW_COLUMNS = [
    "id",
    "created_at",
    "subreddit",
    "title",
    "text",
    "type",
    "sentiment_label",
    "sentiment_score",
]

# Stored post. ``version`` orders the writes of one id. ``batch_id`` and ``dt``
# are folder columns.
TABLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("sentiment_label", T.StringType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("cleaned_text", T.StringType()),
        T.StructField("score_error", T.BooleanType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("insertion_time", T.TimestampType()),
        T.StructField("version", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("dt", T.DateType()),
    ]
)
TABLE_PARTITIONS = ["batch_id", "dt"]
TABLE_DATA_COLUMNS = [c for c in TABLE_SCHEMA.fieldNames() if c not in TABLE_PARTITIONS]
