"""Panels over posts: headline numbers, label shares, communities, trend.

Every panel works on *measures*: a row that stands for ``posts`` posts and
carries their score sum and time range. A single post is a row with
``posts = 1``; a rollup row stands for many. The same panel therefore runs over
raw posts or over a rollup table some thousand times smaller, and rollups of
parts add up to the rollup of the whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedpulse.functions.labels import positive_ratio
from feedpulse.functions.times import QUARTER, floor_ts

ROLLUP_KEYS = ["bucket", "subreddit", "sentiment_label"]
ROLLUP_COLUMNS = [*ROLLUP_KEYS, "posts", "scored", "score_sum", "first_post", "last_post"]

_HOUR = 3_600_000_000
# A bucket unit, the span in microseconds it is used up to, its
# name in the trend's title.
_UNITS = [
    (QUARTER, 12 * _HOUR, "15-Minute Intervals"),
    ("hour", 24 * _HOUR, "Hourly"),
    ("day", 7 * 24 * _HOUR, "Daily"),
    ("week", None, "Weekly"),
]
UNIT_TITLES = {unit: title for unit, _, title in _UNITS}


def as_measures(df: DataFrame) -> DataFrame:
    """Posts as measures; a rollup passes through."""
    if set(ROLLUP_COLUMNS) <= set(df.columns):
        return df.select(*ROLLUP_COLUMNS)
    time = F.col("created_at").cast("timestamp")
    score = F.col("sentiment_score")
    return df.select(
        time.alias("bucket"),
        "subreddit",
        "sentiment_label",
        F.lit(1).cast("long").alias("posts"),
        score.isNotNull().cast("long").alias("scored"),
        F.coalesce(score, F.lit(0.0)).alias("score_sum"),
        time.alias("first_post"),
        time.alias("last_post"),
    )


def rollup_posts(df: DataFrame) -> DataFrame:
    """Measures per quarter hour, community and label; merges rollups likewise.

    Sums and extremes combine on the map side, so a community with a third of
    all posts sends one row per task and quarter hour.
    """
    return (
        as_measures(df)
        .groupBy(floor_ts(F.col("bucket"), QUARTER).alias("bucket"), "subreddit", "sentiment_label")
        .agg(
            F.sum("posts").alias("posts"),
            F.sum("scored").alias("scored"),
            F.sum("score_sum").alias("score_sum"),
            F.min("first_post").alias("first_post"),
            F.max("last_post").alias("last_post"),
        )
    )


def _avg_score() -> Column:
    return F.try_divide(F.sum("score_sum"), F.sum("scored"))


def headline_metrics(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row: posts, communities, mean score, most common label (``N/A`` if none).

    ``avg_score`` is the mean confidence of the winning labels, as the panel has
    always shown it: a confident negative post raises it.

    One scan and one small shuffle: counts by community and counts by label come
    from the same grouping-set aggregate. ``approx=True`` replaces the
    by-community half with a sketch of fixed size per label.
    """
    measures = as_measures(df)
    label = F.col("sentiment_label")
    # min_by skips rows whose order is null, so only label rows compete.
    commonest = F.struct(-F.col("posts"), label)
    if approx:
        by_label = measures.groupBy("sentiment_label").agg(
            F.sum("posts").alias("posts"),
            F.sum("scored").alias("scored"),
            F.sum("score_sum").alias("score_sum"),
            F.hll_sketch_agg("subreddit").alias("communities"),
        )
        total, scored, score_sum = F.col("posts"), F.col("scored"), F.col("score_sum")
        communities = F.hll_sketch_estimate(F.hll_union_agg("communities"))
        of_label = label.isNotNull()
    else:
        by_label = measures.groupingSets(
            [[F.col("subreddit")], [label]], "subreddit", "sentiment_label"
        ).agg(
            F.sum("posts").alias("posts"),
            F.sum("scored").alias("scored"),
            F.sum("score_sum").alias("score_sum"),
            F.grouping("subreddit").alias("label_row"),
        )
        of_community = F.col("label_row") == 0
        total, scored, score_sum = (
            F.when(of_community, F.col(c)) for c in ("posts", "scored", "score_sum")
        )
        communities = F.count(F.when(of_community, F.col("subreddit")))
        of_label = ~of_community & label.isNotNull()
    return by_label.agg(
        F.coalesce(F.sum(total), F.lit(0)).alias("total_posts"),
        F.coalesce(communities, F.lit(0)).alias("unique_subreddits"),
        F.try_divide(F.sum(score_sum), F.sum(scored)).alias("avg_score"),
        F.coalesce(F.min_by(label, F.when(of_label, commonest)), F.lit("N/A")).alias(
            "most_common_label"
        ),
    )


def most_common_label(df: DataFrame) -> DataFrame:
    """The label of most posts, first by name on a tie, ``N/A`` if there is none."""
    return (
        label_distribution(df)
        .agg(
            F.min_by("sentiment_label", F.struct(-F.col("posts"), F.col("sentiment_label"))).alias(
                "most"
            )
        )
        .select(F.coalesce("most", F.lit("N/A")).alias("most_common_label"))
    )


def label_distribution(df: DataFrame) -> DataFrame:
    """Posts and share per label, most frequent first; unlabelled posts are left out.

    The total is a scalar subquery over the same aggregate, whose shuffle Spark
    reuses, so the posts are read and scored once.
    """
    counts = (
        as_measures(df)
        .where(F.col("sentiment_label").isNotNull())
        .groupBy("sentiment_label")
        .agg(F.sum("posts").alias("posts"))
    )
    total = counts.agg(F.sum("posts")).scalar()
    return counts.select(
        "sentiment_label", "posts", (F.col("posts") / total).alias("share")
    ).orderBy(F.desc("posts"), "sentiment_label")


def community_sentiment(df: DataFrame) -> DataFrame:
    """Mean score and posts per community; posts without one are dropped."""
    return (
        as_measures(df)
        .where(F.col("subreddit").isNotNull())
        .groupBy("subreddit")
        .agg(_avg_score().alias("avg_score"), F.sum("posts").alias("posts"))
    )


def top_communities(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` communities with most posts, ties by name."""
    return community_sentiment(df).orderBy(F.desc("posts"), "subreddit").limit(k)


def table_summary(df: DataFrame) -> DataFrame:
    """Newest post time and number of posts."""
    return as_measures(df).agg(
        F.max("last_post").alias("newest_post"),
        F.coalesce(F.sum("posts"), F.lit(0)).alias("records"),
    )


def time_span(df: DataFrame) -> DataFrame:
    """First and last post time and the interval between them."""
    first, last = F.min("first_post"), F.max("last_post")
    return as_measures(df).agg(
        first.alias("first_post"), last.alias("last_post"), (last - first).alias("span")
    )


def _by_span(first: Column, last: Column, of_unit: Callable[[str], Column]) -> Column:
    """``of_unit`` of the unit that suits the span from ``first`` to ``last``."""
    span = F.unix_micros(last) - F.unix_micros(first)
    *narrow, (widest, _, _) = _UNITS
    return F.coalesce(
        *[F.when(span < limit, of_unit(unit)) for unit, limit, _ in narrow], of_unit(widest)
    )


def _trunc_level(unit: str) -> Column:
    return F.lit("minute" if unit == QUARTER else unit)


def _truncate(ts: Column, level: Column) -> Column:
    """Floor to a level known only at run time; null where the level is null.

    Every unit is made of whole quarter hours, so cutting to those first gives
    the quarter hour itself at level ``minute`` and changes nothing at the others.
    """
    return F.call_function("date_trunc", level, floor_ts(ts, QUARTER))


def _level_of_span(df: DataFrame, first: Column, last: Column) -> Column:
    """Truncation level for the span of all rows, as a scalar subquery.

    Spark runs it once, before the stage that needs it, and it reads the time
    column alone.
    """
    return (
        df.agg(first.alias("first"), last.alias("last"))
        .select(_by_span(F.col("first"), F.col("last"), _trunc_level))
        .scalar()
    )


def adaptive_bucket(df: DataFrame, ts: str = "created_at", into: str = "bucket") -> DataFrame:
    """Adds the floor of ``ts`` to the unit that suits the span of all rows.

    Under 12 hours quarter hours, under a day hours, under a week days, else
    weeks.
    """
    time = F.col(ts).cast("timestamp")
    return df.withColumn(into, _truncate(time, _level_of_span(df, F.min(time), F.max(time))))


def sentiment_trend(
    df: DataFrame, positive_label: str = "POSITIVE", unit: str | None = None
) -> DataFrame:
    """Mean score, posts and positive share per bucket, by time.

    The unit follows the span of the data unless given. Undated posts are left
    out, and fewer than two buckets give no rows: that is so exactly when the
    first and the last post share a bucket. The level is empty then, and no
    bucket comes of it.
    """
    measures = as_measures(df).where(F.col("bucket").isNotNull())
    first, last = F.col("first"), F.col("last")

    def level_if_two(of: str) -> Column:
        apart = floor_ts(first, of) < floor_ts(last, of)
        return F.when(apart, _trunc_level(of)).otherwise(F.lit(""))

    level = (
        measures.agg(F.min("first_post").alias("first"), F.max("last_post").alias("last"))
        .select(level_if_two(unit) if unit else _by_span(first, last, level_if_two))
        .scalar()
    )
    return (
        measures.groupBy(_truncate(F.col("bucket"), level).alias("bucket"))
        .agg(
            _avg_score().alias("avg_score"),
            F.sum("scored").alias("posts"),
            positive_ratio(F.col("sentiment_label"), positive_label, F.col("posts")).alias(
                "positive_ratio"
            ),
        )
        .where(F.col("bucket").isNotNull())
        .orderBy("bucket")
    )


def trend_summary(df: DataFrame) -> DataFrame:
    """One row: time range, name of the bucket unit, number of buckets."""
    measures = as_measures(df).where(F.col("bucket").isNotNull())
    level = _level_of_span(measures, F.min("first_post"), F.max("last_post"))
    return (
        measures.groupBy(_truncate(F.col("bucket"), level).alias("bucket"))
        .agg(F.min("first_post").alias("first_post"), F.max("last_post").alias("last_post"))
        .agg(
            F.min("first_post").alias("first_post"),
            F.max("last_post").alias("last_post"),
            F.count(F.lit(1)).alias("points"),
        )
        .select(
            "first_post",
            "last_post",
            _by_span(
                F.col("first_post"), F.col("last_post"), lambda unit: F.lit(UNIT_TITLES[unit])
            ).alias("time_grouping"),
            "points",
        )
    )
