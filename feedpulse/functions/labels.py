"""Label and number expressions used by the panels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_or_unknown(col: Column) -> Column:
    return F.coalesce(F.upper(col), F.lit("UNKNOWN"))


def label_class(col: Column) -> Column:
    """Display colour of a label."""
    label = F.upper(col)
    return (
        F.when(label == "POSITIVE", "green").when(label == "NEGATIVE", "red").otherwise("gray")
    )


def positive_ratio(
    label: Column, positive: str = "POSITIVE", posts: Column | None = None
) -> Column:
    """Share of posts with the positive label; a null label counts as not positive.

    ``posts`` is how many posts one row stands for, one if not given.
    """
    posts = F.lit(1) if posts is None else posts
    return F.sum(F.when(label == positive, posts).otherwise(F.lit(0))) / F.sum(posts)


def two_decimals(col: Column) -> Column:
    return F.format_string("%.2f", col)
