"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded (measures of its letters,
signs and words through a learned layer), a gated attention weighs the passages, and
the weighted sum is scored. Labels are of documents only; which passages count is
learned. Training is on a bounded sample of labelled rows, scoring on every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm.common import documents, free_name, text_or_empty

#: Words in a passage; the last one of a text may have fewer.
PASSAGE = 96
#: Most labelled rows that are learned from, in order of a hash of their id.
SAMPLE = 6000
#: Most passages of one text that are learned from, spread evenly over all of it.
LEARNED = 128
#: Accepted from this score.
ACCEPT = 0.7

UPPER, LOWER, DIGIT, SPACE, SIGN, WIDE = range(6)
KINDS = np.full(256, SIGN, np.int64)
KINDS[[*range(65, 91)]] = UPPER
KINDS[[*range(97, 123)]] = LOWER
KINDS[[*range(48, 58)]] = DIGIT
KINDS[[*range(9, 14), 32]] = SPACE
KINDS[128:] = WIDE
MEASURES = 6 + 33 + 10


def measures(text: str) -> np.ndarray:
    """One row of measures per passage of the whole text, at least one."""
    words = text.encode().split()
    out = np.zeros((max(1, -(-len(words) // PASSAGE)), MEASURES))
    for row, first in zip(out, range(0, len(words), PASSAGE)):
        own = words[first : first + PASSAGE]
        n = len(own)
        letters = np.frombuffer(b"".join(own), np.uint8)
        row[:6] = np.bincount(KINDS[letters], minlength=6)
        # Each ASCII sign on its own.
        signs = letters[KINDS[letters] == SIGN]
        signs = signs[(signs > 32) & (signs < 127)]
        places = np.bincount(SIGN_PLACE[signs], minlength=33)
        row[6:39] = np.sqrt(places[:33] / n)
        sizes = np.array([len(w) for w in own])
        row[:6] /= len(letters)
        counts: dict[bytes, int] = {}
        for w in own:
            counts[w] = counts.get(w, 0) + 1
        row[39] = np.log(n)
        row[40] = len(counts) / n
        row[41] = max(counts.values()) / n
        row[42] = sum(a == b for a, b in zip(own, own[1:])) / n
        row[43] = np.log(sizes.mean())
        row[44] = sizes.std() / sizes.mean()
        row[45] = (sizes > 20).mean()
        row[46] = sum(w.isupper() for w in own) / n
        row[47] = sum(not w[-1:].isalnum() and w[-1] < 128 for w in own) / n
        row[48] = (sizes == 1).mean()
    return out


SIGN_PLACE = np.zeros(256, np.int64)
for _k, _c in enumerate(c for c in range(33, 127) if KINDS[c] == SIGN):
    SIGN_PLACE[_c] = _k


def softmax_by(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    e = np.exp(scores - np.repeat(np.maximum.reduceat(scores, starts), sizes))
    return e / np.repeat(np.add.reduceat(e, starts), sizes)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AttentionModel:
    """Encoder, gated attention and scorer of bags of passages."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        w, starts = self.weights, np.cumsum(sizes) - sizes
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ w["E"] + w["e"])
        t, g = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
        a = softmax_by((t * g) @ w["w"], starts, sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": sigmoid(z @ w["c"] + w["b"])}

    def slopes(self, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Slope of the mean log loss in each weight."""
        f, w = self.forward(x, sizes), self.weights
        starts, n = np.cumsum(sizes) - sizes, len(sizes)
        dz = (f["p"] - labels)[:, None] / n * w["c"]
        dzp = np.repeat(dz, sizes, axis=0)
        da = (dzp * f["h"]).sum(1)
        ds = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), sizes))
        dt = ds[:, None] * w["w"] * f["g"] * (1 - f["t"] ** 2)
        dg = ds[:, None] * w["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dzp + dt @ w["V"].T + dg @ w["U"].T
        dx = dh * (1 - f["h"] ** 2)
        return {
            "E": f["x"].T @ dx,
            "e": dx.sum(0),
            "V": f["h"].T @ dt,
            "U": f["h"].T @ dg,
            "w": (f["t"] * f["g"]).T @ ds,
            "c": f["z"].T @ (f["p"] - labels) / n,
            "b": np.array([(f["p"] - labels).mean()]),
        }

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.empty(0)
        return self.forward(np.concatenate(bags), np.array([len(b) for b in bags]))["p"]

    def attention(self, bag: np.ndarray) -> np.ndarray:
        """Weights of the passages of one document."""
        return self.forward(bag, np.array([len(bag)]))["a"]


def fit(
    bags: list[np.ndarray],
    labels: np.ndarray,
    hidden: int = 16,
    gate: int = 8,
    steps: int = 300,
    rate: float = 0.02,
    decay: float = 1e-4,
    seed: int = 11,
) -> AttentionModel:
    """Maximum likelihood by full-batch Adam; the same bags give the same model."""
    rng = np.random.default_rng(seed)
    x, sizes = np.concatenate(bags), np.array([len(b) for b in bags])
    d = x.shape[1]
    weights = {
        "E": rng.standard_normal((d, hidden)) / np.sqrt(d),
        "e": np.zeros(hidden),
        "V": rng.standard_normal((hidden, gate)) / np.sqrt(hidden),
        "U": rng.standard_normal((hidden, gate)) / np.sqrt(hidden),
        "w": rng.standard_normal(gate) / np.sqrt(gate),
        "c": rng.standard_normal(hidden) / np.sqrt(hidden),
        "b": np.zeros(1),
    }
    model = AttentionModel(x.mean(0), x.std(0) + 1e-3, weights)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    for step in range(1, steps + 1):
        slopes = model.slopes(x, sizes, labels)
        for k, v in weights.items():
            slope = slopes[k] + decay * v
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            v -= (
                rate
                * (first[k] / (1 - 0.9**step))
                / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            )
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: ``crc32`` of the id as text, modulo 4, is 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def spread(bag: np.ndarray, most: int) -> np.ndarray:
    """``bag``, or ``most`` of its rows at even distances, the first and the last with them."""
    if len(bag) <= most:
        return bag
    return bag[np.linspace(0, len(bag) - 1, most).round().astype(int)]


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    passages: int = LEARNED,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
) -> AttentionModel | None:
    """A model from up to ``sample`` labelled documents, or None where none has a label.

    Labels that are null, of null ids, held out, or contradict each other for one id
    are not used. Of rows that repeat an id the greatest text is learned from. At most
    ``passages`` rows of measures per document, spread evenly over its whole text, reach
    the driver: ``sample * passages`` rows in all.
    """
    known = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).cast("long").alias("_label_id"))
        .agg(F.min(label).alias("_label"), F.max(label).alias("_most"))
        .where("_label = _most")
        .orderBy(F.xxhash64("_label_id"), "_label_id")
        .limit(sample)
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = (spread(measures(t.as_py()), passages).tobytes() for t in batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(bags), pa.binary())],
                names=["doc_id", "label", "bag"],
            )

    # ``sample`` rows of two numbers: a side of fixed size.
    chosen = (
        docs.select(F.col(doc_id).cast("long").alias("_label_id"), text_or_empty(text).alias("text"))
        .join(F.broadcast(known), "_label_id")
        .groupBy("_label_id")
        .agg(F.min("_label").cast("long").alias("label"), F.max("text").alias("text"))
    )
    rows = chosen.mapInArrow(encode, "doc_id long, label long, bag binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r["doc_id"])
    bags = [np.frombuffer(r["bag"]).reshape(-1, MEASURES) for r in rows]
    return fit(bags, np.array([float(r["label"] > 0) for r in rows]))


def scored(
    docs: DataFrame, model: AttentionModel | None, text: str = "text", into: str = "_quality"
) -> DataFrame:
    """``docs`` with a score from 0 to 1; 0.5 for all where there is no model.

    Null and empty texts are a bag of one empty passage. The score reads the text
    alone; other columns, null or repeated, pass through as they are, but one called
    ``into`` is an error.
    """
    if free_name(docs, into) != into:
        raise ValueError(f"there is a column {into} already")
    if model is None:
        return docs.withColumn(into, F.lit(0.5))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = list(batch)
            out = [
                model.score([measures(t) for t in texts[k : k + 64]])
                for k in range(0, len(texts), 64)
            ]
            yield pd.Series(np.concatenate(out) if out else np.empty(0))

    return docs.withColumn(into, score(text_or_empty(text)))


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, labels_of(spark, sf_dir))
    return scored(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_quality").alias("score"),
        (F.col("_quality") >= ACCEPT).cast("int").alias("predicted"),
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose score is accepted; without labels all stay."""
    model = train(docs, labels_of(spark, sf_dir))
    if model is None:
        return docs
    own = free_name(docs, "_quality")
    return scored(docs, model, into=own).where(F.col(own) >= ACCEPT).drop(own)
