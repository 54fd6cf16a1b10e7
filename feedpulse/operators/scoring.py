"""Sentiment of a post: short-text rule, chunks, scorer slot, best chunk."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.functions.text import (
    CHUNK_SIZE,
    chunk_text,
    combine_text,
    is_too_short,
    normalize_mentions_links,
)
from feedpulse.functions.wordlists import NEGATIVE_WORDS, POSITIVE_WORDS
from feedpulse.operators.language import LETTER_RUNS

NEUTRAL = "neutral"
NEUTRAL_SCORE = 0.5
# The labels of a result.
LABELS = ("positive", "negative", "neutral")


class Scorer(Protocol):
    """Turns an array of chunks into ``struct<label, score, score_error>``.

    The struct is the verdict of the most confident chunk, the earlier one on a
    tie. A null array is a post too short to score.
    """

    def best_chunk(self, chunks: Column) -> Column: ...


class LexiconScorer:
    """Counts positive and negative words; built-in expressions only.

    With ``p`` and ``n`` hits the label is the sign of ``p - n`` and the
    confidence ``0.5 + 0.5 * |p - n| / (p + n)``, 0.5 where nothing was hit.
    """

    def __init__(
        self,
        positive: Sequence[str] = POSITIVE_WORDS,
        negative: Sequence[str] = NEGATIVE_WORDS,
    ):
        self.positive = list(positive)
        self.words = list(positive) + list(negative)

    def best_chunk(self, chunks: Column) -> Column:
        hits = F.transform(
            chunks,
            lambda chunk: F.filter(
                F.split(F.lower(chunk), LETTER_RUNS), lambda t: t.isin(*self.words)
            ),
        )
        counts = F.transform(
            hits,
            lambda found, pos: F.struct(
                F.size(F.filter(found, lambda t: t.isin(*self.positive))).alias("p"),
                F.size(found).alias("all"),
                pos.alias("pos"),
            ),
        )
        verdicts = F.transform(
            counts,
            lambda c: F.struct(
                F.when(
                    c["all"] > 0,
                    F.lit(0.5) + F.lit(0.5) * F.abs(c["p"] * 2 - c["all"]) / c["all"],
                )
                .otherwise(F.lit(NEUTRAL_SCORE))
                .alias("score"),
                (-c["pos"]).alias("earlier"),
                F.when(c["p"] * 2 > c["all"], "positive")
                .when(c["p"] * 2 < c["all"], "negative")
                .otherwise(NEUTRAL)
                .alias("label"),
            ),
        )
        # One-element array: binds the winner once for the three fields read.
        return F.transform(
            F.array(F.array_max(verdicts)),
            lambda best: F.struct(
                best["label"].alias("label"),
                best["score"].alias("score"),
                F.lit(False).alias("score_error"),
            ),
        )[0]


class ModelScorer:
    """Scores with any Python model, fed in batches on the executors.

    ``load`` runs on the executor and returns a callable that maps a list of
    texts to one result each: ``(label, confidence)`` or a dict with ``label``
    and ``score``. A Python worker loads the model once and keeps it for all
    tasks and micro-batches of this scorer. Everything the workers need travels
    with the function, so this package need not be installed there.

    A model call gets about ``batch_chunks`` texts, those of one post together.
    A call fails where it raises, or gives too many or too few results, a label
    that is none, or a confidence that is no number from 0 to 1. Its posts are then
    tried one by one, and a post that still fails is neutral with ``score_error``
    set, so neither a bad post nor a bad call ends the job.
    """

    def __init__(self, load: Callable[[], Callable[[list[str]], Any]], batch_chunks: int = 64):
        self.load = load
        self.batch_chunks = batch_chunks
        self.key = uuid.uuid4().hex

    def best_chunk(self, chunks: Column) -> Column:
        key, load, enough = self.key, self.load, self.batch_chunks
        failed = (NEUTRAL, NEUTRAL_SCORE, True)

        def worker_model():
            # Modules outlive a task; functions sent to a worker do not.
            holder = sys.modules.setdefault("_loaded_scorers", types.ModuleType("_loaded_scorers"))
            models = holder.__dict__.setdefault("models", {})
            if key not in models:
                models[key] = load()
            return models[key]

        def verdicts(model, posts):
            chunks = [chunk for post in posts for chunk in post]
            results = [
                (r["label"], r["score"]) if isinstance(r, dict) else (r[0], r[1])
                for r in model(chunks)
            ]
            if len(results) != len(chunks):
                raise ValueError(f"{len(results)} results for {len(chunks)} texts")
            checked = [(str(label).lower(), float(score)) for label, score in results]
            for label, score in checked:
                if label not in LABELS or not 0.0 <= score <= 1.0:  # NaN fails as well
                    raise ValueError(f"no result: {label!r}, {score}")
            out, own = [], iter(checked)
            for post in posts:
                # max() keeps the first of equals: the earlier chunk wins a tie.
                label, score = max((next(own) for _ in post), key=lambda pair: pair[1])
                out.append((label, score, False))
            return out

        def guarded(model, posts):
            try:
                return verdicts(model, posts)
            except Exception:
                if len(posts) == 1:
                    return [failed]
                return [row for post in posts for row in guarded(model, [post])]

        def calls(posts):
            some, size = [], 0
            for i, post in enumerate(posts):
                if post is None or len(post) == 0:
                    continue
                some.append(i)
                size += len(post)
                if size >= enough:
                    yield some
                    some, size = [], 0
            if some:
                yield some

        @F.pandas_udf("label string, score double, score_error boolean")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            model = worker_model()
            for batch in batches:
                posts = list(batch)
                rows = [(None, None, None)] * len(posts)
                for some in calls(posts):
                    for i, row in zip(some, guarded(model, [list(posts[i]) for i in some])):
                        rows[i] = row
                yield pd.DataFrame(rows, columns=["label", "score", "score_error"]).astype(
                    {"label": "object", "score": "float64", "score_error": "object"}
                )

        # Not declared deterministic, or a later filter on the label would be moved
        # below it with a copy of the call, and the model would run twice.
        return score.asNondeterministic()(chunks)


def score_posts(
    df: DataFrame,
    scorer: Scorer | None = None,
    size: int = CHUNK_SIZE,
    max_chunks: int | None = None,
) -> DataFrame:
    """Adds ``sentiment_label``, ``sentiment_score``, ``cleaned_text``, ``score_error``.

    Whole texts are scored; ``max_chunks`` limits that to their first chunks. Posts
    under three characters get a neutral result and never reach the scorer.
    ``cleaned_text`` is the normalised text, whole. All of it is inside the row; a
    later filter on the label is checked in the task that read the post.
    """
    scorer = scorer or LexiconScorer()
    combined = combine_text(F.col("title"), F.col("text"))
    short = F.col("_short")
    prepared = df.withColumn("_short", is_too_short(combined)).withColumn(
        "_processed", F.when(~short, normalize_mentions_links(combined))
    )
    scored = prepared.withColumn(
        "_best", scorer.best_chunk(chunk_text(F.col("_processed"), size, max_chunks))
    )
    error = F.coalesce(F.col("_best.score_error"), F.lit(False))
    return scored.select(
        *[F.col(c) for c in df.columns],
        F.coalesce(F.col("_best.label"), F.lit(NEUTRAL)).alias("sentiment_label"),
        F.coalesce(F.col("_best.score"), F.lit(NEUTRAL_SCORE)).alias("sentiment_score"),
        F.when(short, F.lit("")).otherwise(F.col("_processed")).alias("cleaned_text"),
        error.alias("score_error"),
    )


def check_scorer(spark: SparkSession, scorer: Scorer, text: str = "A good day.") -> None:
    """One post through the scorer before a stream starts; raises if it fails."""
    post = spark.range(1).select(F.lit(text).alias("title"), F.lit("").alias("text"))
    row = score_posts(post, scorer).first()
    if row.score_error or row.sentiment_label not in LABELS:
        raise ValueError(f"scorer check failed: {row.sentiment_label!r}, error={row.score_error}")
    if not 0.0 <= row.sentiment_score <= 1.0:
        raise ValueError(f"scorer check failed: confidence {row.sentiment_score}")
