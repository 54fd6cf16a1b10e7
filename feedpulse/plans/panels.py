"""All panels of the dashboard at once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedpulse.operators.metrics import (
    headline_metrics,
    label_distribution,
    sentiment_trend,
    table_summary,
    top_communities,
    trend_summary,
)
from feedpulse.operators.view import recent_posts


def dashboard(view: DataFrame, rollup: DataFrame | None = None) -> dict[str, DataFrame]:
    """One lazy DataFrame per panel.

    ``view`` is the read view of the table. Given a stored ``rollup`` of it, every
    panel but the latest posts reads that instead and leaves the posts alone.
    """
    measures = view if rollup is None else rollup
    return {
        "headline": headline_metrics(measures),
        "distribution": label_distribution(measures),
        "communities": top_communities(measures),
        "trend": sentiment_trend(measures),
        "trend_summary": trend_summary(measures),
        "summary": table_summary(measures),
        "recent_posts": recent_posts(view),
    }
