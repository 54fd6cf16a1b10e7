"""Messages, feed filters and language."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedpulse.operators.language import detect_language, language_of, keep_language
from feedpulse.schema import POST_COLUMNS
from feedpulse.sources.feed import clean_feed, posts_feed, posts_since, stream_options
from feedpulse.sources.messages import (
    decode_kafka,
    parse_posts,
    require_key,
    split_valid,
    to_messages,
    write_messages,
)

VALID = (
    '{"id":"a","created_at":1716500000.0,"subreddit":"s","title":"T","text":null,'
    '"type":"submission"}'
)
BAD = ['{"id":"cut', "not json", "[]", "null", '{"title":"no id"}', None, ""]


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def posts(spark, *rows):
    return spark.createDataFrame(
        [(str(i), 1716500000 + i, *row) for i, row in enumerate(rows)],
        "id string, created_at bigint, subreddit string, title string, text string",
    )


def test_parse_whole_and_fractional_seconds(spark):
    values = [VALID, VALID.replace("1716500000.0", "1716500000"), '{"id":7,"created_at":"soon"}']
    rows = parse_posts(messages(spark, *values)).collect()
    assert [r.id for r in rows] == ["a", "a", "7"]
    assert [r.created_at for r in rows] == [datetime(2024, 5, 23, 21, 33, 20)] * 2 + [None]
    assert rows[0].text is None


def test_out_of_range_time_is_null(spark):
    rows = parse_posts(messages(spark, '{"id":"a","created_at":1e300}')).collect()
    assert rows[0].created_at is None and rows[0].id == "a"


def test_split_valid(spark):
    parsed = parse_posts(messages(spark, VALID, *BAD, '{"id":"b"}'))
    valid, dead = split_valid(parsed)
    assert [r.id for r in valid.orderBy("id").collect()] == ["a", "b"]
    assert [c for c in valid.columns if c != "value"] == POST_COLUMNS
    reasons = {r.value: r.reason for r in dead.collect()}
    assert reasons == {
        '{"id":"cut': "malformed",
        "not json": "malformed",
        "[]": "malformed",
        "null": "malformed",
        '{"title":"no id"}': "no_key",
        None: "empty",
        "": "empty",
    }
    assert require_key(parsed).count() == 2


def test_message_roundtrip(spark):
    df = posts(spark, ("s", 'q"uote\n', "é\U0001f600 \\"), ("t", None, "")).withColumn(
        "type", F.lit("submission")
    )
    sent = to_messages(df)
    back = parse_posts(decode_kafka(sent.select(F.col("value").cast("binary"), "key")))
    assert sent.columns == ["key", "value"]
    assert '"title":null' in sent.where("key = '1'").first().value
    want = df.withColumn("created_at", F.timestamp_seconds("created_at")).select(*POST_COLUMNS)
    assert sorted(map(str, back.select(*POST_COLUMNS).collect())) == sorted(
        map(str, want.collect())
    )


def test_kafka_positions_are_kept(spark):
    df = spark.createDataFrame(
        [(b"k", b"v", "topic", 3, 42, datetime(2024, 1, 1))],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    row = decode_kafka(df).first()
    assert (row.key, row.value, row.partition, row.offset) == ("k", "v", 3, 42)


def test_write_messages_as_lines(spark, tmp_path):
    df = posts(spark, ("s", "one", "x"), ("s", "two\nlines", "y")).withColumn("type", F.lit("t"))
    write_messages(df, "text", path=str(tmp_path / "out"))
    back = parse_posts(spark.read.text(str(tmp_path / "out")))
    assert sorted(r.title for r in back.collect()) == ["one", "two\nlines"]


def test_stream_options():
    assert stream_options("kafka", "latest", 100) == {
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "100",
    }
    assert stream_options("kafka", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    assert stream_options("text", max_per_batch=2, fail_on_data_loss=False) == {
        "ignoreMissingFiles": "true",
        "maxFilesPerTrigger": "2",
    }


def test_clean_feed(spark):
    raw = posts(
        spark,
        ("a", "  What is this? ", "\tIt is the best of the year\n"),
        ("a", " ", " "),
        ("a", None, None),
        ("b", "the and of", "not in the feed"),
        ("a", "Das ist nicht", "ein Problem für die Leute"),
        ("a", "123 !!!", ""),
        ("a", None, "this is for you"),
    )
    kept = clean_feed(raw, ["a"]).orderBy("id").collect()
    assert [(r.id, r.title, r.text, r.type) for r in kept] == [
        ("0", "What is this?", "It is the best of the year", "submission"),
        ("6", "", "this is for you", "submission"),
    ]
    assert clean_feed(raw, None, language=None).count() == 5
    assert [r.id for r in clean_feed(raw, None, "de", "comment").collect()] == ["4"]


def test_feed_by_list_or_table(spark):
    raw = posts(spark, ("a", "x", ""), ("b", "y", ""), (None, "z", ""), ("c", "w", ""))
    wanted = spark.createDataFrame([("a",), ("c",), ("a",)], "subreddit string")
    by_list = posts_feed(raw, ["a", "c"])
    by_table = posts_feed(raw, wanted)
    assert by_table.columns == raw.columns
    assert sorted(r.id for r in by_list.collect()) == sorted(r.id for r in by_table.collect())
    assert by_list.count() == 2


def test_posts_since(spark):
    df = posts(spark, ("a", "x", ""), ("a", "y", "")).withColumn(
        "created_at", F.timestamp_seconds("created_at")
    )
    assert posts_since(df, datetime(2024, 5, 23, 21, 33, 21)).count() == 1


@pytest.mark.parametrize(
    "text,lang",
    [
        ("The cat is on the table", "en"),
        ("Der Hund und die Katze", "de"),
        ("le chat est dans les arbres", "fr"),
        ("el perro y los gatos", "es"),
        ("il gatto non è della signora", "it"),
        ("de kat zit niet op het dak", "nl"),
        ("nie wiem co to jest", "pl"),
        ("o gato não está em uma casa", "pt"),
        ("katten och hunden är inte här", "sv"),
        ("123 !!!", None),
        ("zzz", None),
        ("", None),
        (None, None),
        ("ein the", "de"),  # a tie goes to the first by name
        ("Привет", None),
    ],
)
def test_language(spark, text, lang):
    df = spark.createDataFrame([(text,)], "text string")
    assert detect_language(df).first().lang_detected == lang
    assert keep_language(detect_language(df), "en").count() == (lang == "en")


def test_language_of_the_documents(spark):
    """The table names the language it was written in; few may be told wrong."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    right = detect_language(docs).where("lang = lang_detected").count()
    assert right > 0.97 * docs.count()


@pytest.mark.parametrize(
    "title", ["Apple unveils new iPhone", "Breaking: massive wildfire near Los Angeles"]
)
def test_titles_with_hardly_any_function_words(spark, title):
    df = spark.createDataFrame([(title, "")], "title string, text string")
    assert detect_language(df, "title").first().lang_detected == "en"


def test_language_accuracy(spark):
    """Share of given texts and of their first lines that are told right."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = docs.select(
        "lang",
        language_of(F.col("text")).alias("whole"),
        language_of(F.substring_index("text", "\n", 1)).alias("title"),
    ).agg(*[F.avg((F.col(c).eqNullSafe(F.col("lang"))).cast("int")).alias(c) for c in ("whole", "title")])
    shares = told.first()
    assert shares.whole >= 0.97 and shares.title >= 0.9
