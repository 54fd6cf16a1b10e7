"""Panels on hand-made rows, and the same panels over rollups."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedpulse.operators import metrics as m
from feedpulse.operators.view import (
    post_cards,
    posts_view,
    raw_sample,
    recent_posts,
    schema_report,
    table_columns,
)
from feedpulse.plans.panels import dashboard
from feedpulse.schema import VIEW_COLUMNS

T0 = datetime(2024, 5, 20, 10, 7)  # a Monday
SCHEMA = (
    "id string, created_at timestamp, subreddit string, title string, text string, "
    "type string, sentiment_label string, sentiment_score double"
)


def view(spark, *rows):
    """Rows of (minutes after T0 or None, community, label, score)."""
    return spark.createDataFrame(
        [
            (
                str(i),
                None if minutes is None else T0 + timedelta(minutes=minutes),
                sub,
                "t",
                "x",
                "submission",
                label,
                score,
            )
            for i, (minutes, sub, label, score) in enumerate(rows)
        ],
        SCHEMA,
    )


SOME = [
    (0, "b", "POSITIVE", 0.9),
    (3, "a", "NEGATIVE", 0.7),
    (20, "a", None, 0.5),
    (60, None, "NEGATIVE", 0.6),
    (None, "c", "POSITIVE", 0.8),
    (400, "b", "NEUTRAL", 0.5),
]


@pytest.mark.parametrize("prepare", [lambda df: df, m.rollup_posts])
def test_headline(spark, prepare):
    row = m.headline_metrics(prepare(view(spark, *SOME))).first()
    assert (row.total_posts, row.unique_subreddits) == (6, 3)
    assert row.avg_score == pytest.approx(4.0 / 6)
    assert row.most_common_label == "NEGATIVE"  # ties with POSITIVE, first by name


def test_headline_of_nothing(spark):
    row = m.headline_metrics(view(spark, (0, "a", "X", 1.0)).where("false")).first()
    assert row.asDict() == {
        "total_posts": 0,
        "unique_subreddits": 0,
        "avg_score": None,
        "most_common_label": "N/A",
    }
    unlabelled = m.headline_metrics(view(spark, (0, "a", None, 1.0))).first()
    assert unlabelled.most_common_label == "N/A"
    assert m.most_common_label(view(spark, (0, "a", None, 1.0))).first()[0] == "N/A"


def test_headline_approx(spark):
    rows = [(i % 50, f"s{i % 40}" if i % 9 else None, "NEUTRAL", 0.5) for i in range(400)]
    row = m.headline_metrics(view(spark, *rows), approx=True).first()
    assert row.total_posts == 400
    assert abs(row.unique_subreddits - 40) <= 2
    assert row.most_common_label == "NEUTRAL"
    none = m.headline_metrics(view(spark, (0, None, None, 0.5)), approx=True).first()
    assert (none.total_posts, none.unique_subreddits, none.most_common_label) == (1, 0, "N/A")


def test_distribution(spark):
    rows = m.label_distribution(view(spark, *SOME)).collect()
    assert [(r.sentiment_label, r.posts, r.share) for r in rows] == [
        ("NEGATIVE", 2, 0.4),
        ("POSITIVE", 2, 0.4),
        ("NEUTRAL", 1, 0.2),
    ]


def test_communities(spark):
    df = view(spark, *SOME)
    rows = {r.subreddit: (r.avg_score, r.posts) for r in m.community_sentiment(df).collect()}
    assert rows == {
        "a": (pytest.approx(0.6), 2),
        "b": (pytest.approx(0.7), 2),
        "c": (pytest.approx(0.8), 1),
    }
    assert [r.subreddit for r in m.top_communities(df, 2).collect()] == ["a", "b"]


@pytest.mark.parametrize(
    "minutes,title",
    [
        (719, "15-Minute Intervals"),
        (720, "Hourly"),
        (1439, "Hourly"),
        (1440, "Daily"),
        (10079, "Daily"),
        (10080, "Weekly"),
    ],
)
@pytest.mark.parametrize("prepare", [lambda df: df, m.rollup_posts])
def test_unit_follows_span(spark, prepare, minutes, title):
    df = prepare(view(spark, (0, "a", "POSITIVE", 0.9), (minutes, "a", None, 0.5)))
    facts = m.trend_summary(df).first()
    assert facts.time_grouping == title
    assert facts.points == 2
    floors = {
        "15-Minute Intervals": T0.replace(minute=0),
        "Hourly": T0.replace(minute=0),
        "Daily": T0.replace(hour=0, minute=0),
        "Weekly": T0.replace(hour=0, minute=0),
    }
    trend = m.sentiment_trend(df).select(F.col("bucket").cast("string"), "posts").collect()
    assert trend[0][0] == str(floors[title])
    assert [r.posts for r in trend] == [1, 1]


def test_week_starts_on_monday(spark):
    sunday = (datetime(2024, 5, 26, 23, 59) - T0).total_seconds() / 60
    df = view(spark, (0, "a", None, 0.5), (sunday, "a", None, 0.5), (sunday + 1, "a", None, 0.5))
    weeks = m.sentiment_trend(df, unit="week").collect()
    assert [r.posts for r in weeks] == [2, 1]


def test_null_label_is_not_positive(spark):
    df = view(spark, (0, "a", "POSITIVE", 0.9), (1, "a", None, 0.5), (30, "a", "POSITIVE", 0.5))
    trend = m.sentiment_trend(df).collect()
    assert [r.positive_ratio for r in trend] == [0.5, 1.0]
    assert trend[0].avg_score == pytest.approx(0.7)


def test_one_bucket_is_no_trend(spark):
    df = view(spark, (0, "a", "POSITIVE", 0.9), (7, "b", "NEGATIVE", 0.5), (None, "b", "X", 1.0))
    assert m.sentiment_trend(df).count() == 0
    assert m.sentiment_trend(df, unit="day").count() == 0
    assert m.trend_summary(df).first().points == 1
    assert m.sentiment_trend(df.where("false")).count() == 0


def test_rollups_add_up(spark):
    labels = ["POSITIVE", "NEGATIVE", None]
    rows = [(i * 7 % 900, f"s{i % 5}", labels[i % 3], i / 100) for i in range(90)]
    whole = view(spark, *rows)
    parts = m.rollup_posts(whole.where("id < 30")).unionByName(
        m.rollup_posts(whole.where("id >= 30"))
    )

    def lines(df):
        rounded = df.withColumn("score_sum", F.round("score_sum", 9))
        return sorted(str(tuple(r)) for r in rounded.collect())

    assert lines(m.rollup_posts(parts)) == lines(m.rollup_posts(whole))


def test_dashboard_from_posts_and_from_rollup(spark):
    rows = [(i * 31, f"s{i % 4}", ["POSITIVE", "NEGATIVE", None][i % 3], 0.5) for i in range(60)]
    df = view(spark, *rows)
    direct, rolled = dashboard(df), dashboard(df, m.rollup_posts(df))
    assert direct.keys() == rolled.keys()
    for name in direct:
        assert direct[name].collect() == rolled[name].collect(), name
    assert direct["trend"].count() == 2


def test_span_and_summary(spark):
    df = view(spark, *SOME)
    span = m.time_span(df).first()
    assert span.span == timedelta(minutes=400)
    assert m.table_summary(df).first().records == 6
    assert m.table_summary(df).first().newest_post == T0 + timedelta(minutes=400)


def test_posts_view_defaults(spark):
    stored = spark.createDataFrame(
        [("a", 0, None, None, None, None, "positive", None), ("b", 1716500000, *[None] * 6)],
        "id string, created_at bigint, subreddit string, title string, text string, type string, "
        "sentiment_label string, sentiment_score double",
    )
    a, b = posts_view(stored).orderBy("id").collect()
    assert (a.created_at, a.title, a.text, a.sentiment_label, a.sentiment_score) == (
        None,
        "",
        "",
        "POSITIVE",
        0.5,
    )
    assert str(b.created_at) == "2024-05-23 21:33:20"
    zero = stored.withColumn("created_at", F.timestamp_seconds(F.lit(0)))
    assert posts_view(zero).first().created_at is None


def test_cards(spark):
    df = view(spark, (0, "a", None, 0.5), (5, "b", "negative", 0.25), (None, "c", "POSITIVE", 0.5))
    cards = recent_posts(df, 3).collect()
    assert [c.id for c in cards] == ["1", "0", "2"]
    assert [c.sentiment for c in cards] == ["NEGATIVE", "UNKNOWN", "POSITIVE"]
    assert [c.color for c in cards] == ["red", "gray", "green"]
    assert [c.posted for c in cards] == ["2024-05-20 10:12:00", "2024-05-20 10:07:00", "Unknown"]
    assert cards[0].score_text == "0.25"
    assert post_cards(df).count() == 3
    assert [r.id for r in raw_sample(df, 2, "id").collect()] == ["0", "1"]


def test_schema_report(spark):
    df = view(spark, *SOME).drop("type").withColumn("odd.name", F.lit(1))
    report = {r.column_name: r for r in schema_report(df, VIEW_COLUMNS, True).collect()}
    assert report["type"].status == "missing" and report["type"].filled == 0
    assert report["odd.name"].status == "extra" and report["odd.name"].filled == 6
    assert report["created_at"].filled == 5 and report["created_at"].type == "timestamp"
    assert ("sentiment_score", "double") in table_columns(df)
    plain = schema_report(df, VIEW_COLUMNS)
    assert {r.column_name: r.status for r in plain.collect()} == {
        name: r.status for name, r in report.items()
    }
