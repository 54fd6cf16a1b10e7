"""Models learned from counts of hashed features: language of a text, label of a post.

Learning is one pass: tasks count the features of their rows by label, Spark adds the
counts up, and a smoothed log-likelihood of each feature under each label is the model
(multinomial naive Bayes, linear in the counts). It has ``buckets`` numbers a label,
whatever the rows. Features are runs of three letters, or words and pairs of words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.functions.text import blank_if_null
from feedpulse.operators.scoring import ModelScorer

BUCKETS = 1 << 15
#: Added to each count, so that no feature rules a label out.
SMOOTHING = 0.5
_NO_LETTER = re.compile(r"[\W\d_]+")
_WORD = re.compile(r"[^\W_]+")


def letter_features(text: str, buckets: int) -> np.ndarray:
    """Numbers of the runs of three letters of ``text``, word edges included."""
    letters = _NO_LETTER.sub(" ", f" {text.lower()} ")
    points = np.frombuffer(letters.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    if len(points) < 4:  # a letter and its edges at least, and not all of it edges
        return np.empty(0, np.int64)
    mixed = points[:-2] * np.uint64(0x9E3779B1) + points[1:-1] * np.uint64(0x85EBCA77) + points[2:]
    mixed = (mixed ^ (mixed >> np.uint64(15))) * np.uint64(0x2C1B3C6D)
    return ((mixed >> np.uint64(11)) % np.uint64(buckets)).astype(np.int64)


def word_features(text: str, buckets: int) -> np.ndarray:
    """Numbers of the words of ``text`` and of words that stand side by side."""
    words = [w.encode("utf-8", "replace") for w in _WORD.findall(text.lower())]
    pairs = [a + b" " + b for a, b in zip(words, words[1:])]
    return np.fromiter((zlib.crc32(w) % buckets for w in words + pairs), np.int64)


FEATURES = {"letters": letter_features, "words": word_features}


class LearnedModel:
    """Labels and the weights of features under each; made by :func:`learn`."""

    def __init__(self, labels: list[str], weights: np.ndarray, prior: np.ndarray, features: str):
        self.labels, self.weights, self.prior, self.features = labels, weights, prior, features

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of each text under each label, and its number of features."""
        make, buckets = FEATURES[self.features], len(self.weights)
        found = [make(t or "", buckets) for t in texts]
        sizes = np.array([len(f) for f in found])
        out = np.tile(self.prior, (len(texts), 1))
        for k, own in enumerate(found):
            if len(own):
                out[k] += self.weights[own].sum(0)
        return out, sizes

    def label_of(self, col: Column) -> Column:
        """The likeliest label of a text; null where it has no features."""
        model = self

        @F.pandas_udf("string")
        def label(texts: pd.Series) -> pd.Series:
            scores, sizes = model.scores(texts.tolist())
            best = np.array(model.labels, object)[scores.argmax(1)]
            return pd.Series(np.where(sizes > 0, best, None))

        return label(col)

    def scorer(self) -> ModelScorer:
        """The model in the scorer slot; its labels must be those of posts.

        Confidence is the likelihood of the label per square root of the features, as
        neighbouring features are no independent signs.
        """
        model = self

        def load() -> Callable[[list[str]], list[tuple[str, float]]]:
            def verdicts(texts: list[str]) -> list[tuple[str, float]]:
                scores, sizes = model.scores(texts)
                scores = (scores - scores.max(1, keepdims=True)) / np.sqrt(np.maximum(sizes, 1))[:, None]
                likely = np.exp(scores)
                likely /= likely.sum(1, keepdims=True)
                return [(model.labels[k], float(row[k])) for k, row in zip(likely.argmax(1), likely)]

            return verdicts

        return ModelScorer(load)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(n, self.features, float(p), w.tolist()) for n, p, w in zip(self.labels, self.prior, self.weights.T)]
        schema = "label string, features string, prior double, weights array<double>"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> LearnedModel:
        rows = spark.read.parquet(path).orderBy("label").collect()  # a row a label
        weights = np.array([r.weights for r in rows]).T
        return cls([r.label for r in rows], weights, np.array([r.prior for r in rows]), rows[0].features)


def learn(
    df: DataFrame, text: str, label: str, features: str = "letters", buckets: int = BUCKETS
) -> LearnedModel:
    """A model of ``label`` from all rows of ``df`` that have one.

    Texts without features, and null ones, teach how common a label is and no more. The
    driver gets ``buckets`` counts a label. No labelled rows are a ``ValueError``.
    """
    make = FEATURES[features]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for own, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name not in counts:
                    counts[name] = np.zeros(buckets + 1, np.int64)
                np.add.at(counts[name], make(own, buckets), 1)
                counts[name][buckets] += 1
        for name, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(own[at])],
                names=["label", "bucket", "n"],
            )

    rows = df.where(F.col(label).isNotNull()).select(
        blank_if_null(F.col(text)).alias("text"), F.col(label).cast("string").alias("label")
    )
    summed = (
        rows.mapInArrow(count, "label string, bucket long, n long")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    if not summed:
        raise ValueError("no row has a label to learn")
    labels = sorted({r.label for r in summed})
    counts = np.zeros((buckets + 1, len(labels)))
    for r in summed:
        counts[r.bucket, labels.index(r.label)] = r.n
    likely = counts[:buckets] + SMOOTHING
    weights = np.log(likely / likely.sum(0))
    return LearnedModel(labels, weights, np.log(counts[buckets] / counts[buckets].sum()), features)
