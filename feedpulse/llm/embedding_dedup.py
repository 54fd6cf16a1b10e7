"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation is learned on a bounded sample so that the signs of the rotated axes make
balanced binary codes (principal axes, then alternating between the codes and the
rotation that fits them). Codes of 64 bits are cut into four of 16, one table each.
A pair meets where a quarter of its codes differs in two bits at most: every code
is entered under itself and its 16 neighbours at one bit, so two that differ in two
bits meet half-way. Each pair is taken at one meeting only, in the first of its
tables. Candidates whose whole codes are near are reranked with the original vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm.common import ROW, components, row_key, written

COSINE = 0.95
BITS = 64
TABLES = 4
WIDTH = BITS // TABLES
#: Rows the rotation is fitted on, by order of a hash; all rows are indexed.
SAMPLE = 20_000
STEPS = 40
#: Whole codes further apart are no candidates; vectors at the threshold differ in
#: 6.5 bits on average, with a deviation of 2.4.
FARTHEST = 18


def fit_rotation(vectors: np.ndarray, steps: int = STEPS, seed: int = 17) -> np.ndarray:
    """Projection of unit vectors onto ``BITS`` axes (or as many as they have)."""
    bits = min(BITS, vectors.shape[1])
    _, axes = np.linalg.eigh(vectors.T @ vectors)
    axes = axes[:, ::-1][:, :bits]
    flat = vectors @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))[0]
    for _ in range(steps):
        codes = np.where(flat @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(flat.T @ codes)
        turn = left @ right
    return axes @ turn


def unit_rows(vectors: list, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, and which rows are usable."""
    good = np.zeros(len(vectors), bool)
    out = np.zeros((len(vectors), size))
    for k, v in enumerate(vectors):
        if v is not None and len(v) == size and None not in v:
            x = np.array(v, float)
            most = np.abs(x).max()  # NaN where any component is
            if np.isfinite(most) and most > 0:
                x = x / most
                out[k], good[k] = x / np.sqrt(x @ x), True
    return out, good


def coded(vectors: DataFrame, size: int, rotation: np.ndarray, embedding: str, vec_id: str) -> DataFrame:
    """``(row, vec_id, digest, code, unit)`` of every row, stored; null where unusable."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (1 << np.arange(rotation.shape[1], dtype=np.uint64)).astype(np.uint64)
        for batch in batches:
            given = batch.column(2).to_pylist()
            units, good = unit_rows(given, size)
            codes = ((units @ rotation >= 0) * weights).sum(1, dtype=np.uint64).view(np.int64)
            bad = ~good
            raw = [np.array(v, "<f8").tobytes() if ok else None for v, ok in zip(given, good)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(
                        [x and hashlib.blake2b(x, digest_size=16).digest() for x in raw], pa.binary()
                    ),
                    pa.array(codes, mask=bad),
                    pa.array(
                        [u.astype("<f8").tobytes() if ok else None for u, ok in zip(units, good)],
                        pa.binary(),
                    ),
                ],
                names=[ROW, "vec_id", "digest", "code", "unit"],
            )

    keyed = row_key(vectors).select(
        ROW,
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("embedding"),
    )
    return written(
        keyed.mapInArrow(
            encode, f"{ROW} long, vec_id long, digest binary, code long, unit binary"
        ),
        "codes",
    )


def quarter(code: Column, table: int) -> Column:
    return F.shiftrightunsigned(code, WIDTH * table).bitwiseAND(F.lit((1 << WIDTH) - 1))


def entries(nodes: DataFrame) -> DataFrame:
    """``(place, node, code)``: each code under 17 keys in each of the tables."""
    keys = [
        (F.lit(table << WIDTH) + quarter(F.col("code"), table).bitwiseXOR(F.lit(flip)))
        for table in range(TABLES)
        for flip in [0, *(1 << b for b in range(WIDTH))]
    ]
    return nodes.select(F.explode(F.array(*keys)).alias("place"), "node", "code")


def candidates(nodes: DataFrame) -> DataFrame:
    """Pairs ``(a, b)``, each once."""
    a = entries(nodes).select("place", F.col("node").alias("a"), F.col("code").alias("code_a"))
    b = entries(nodes).select("place", F.col("node").alias("b"), F.col("code").alias("code_b"))
    x = F.col("code_a").bitwiseXOR(F.col("code_b"))
    first = F.coalesce(*[F.when(F.bit_count(quarter(x, t)) <= 2, F.lit(t)) for t in range(TABLES)])
    table = F.shiftright("place", WIDTH)
    # At a distance of two there are two meetings: that at the lower bit counts. At
    # less there are more, and the quarter of the first node counts.
    own = F.coalesce(*[F.when(table == t, quarter(F.col("code_a"), t)) for t in range(TABLES)])
    gap = F.coalesce(*[F.when(table == t, quarter(x, t)) for t in range(TABLES)])
    step = F.when(F.bit_count(gap) == 2, gap.bitwiseAND(-gap)).otherwise(F.lit(0))
    return (
        a.join(b, "place")
        .where(
            (F.col("a") < F.col("b"))
            & (F.bit_count(x) <= FARTHEST)
            & (first == table)
            & (F.col("place").bitwiseAND((1 << WIDTH) - 1) == own.bitwiseXOR(step))
        )
        .select("a", "b")
    )


def reranked(pairs: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """Pairs whose original vectors have a cosine of at least ``cosine``."""

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = (
                    np.frombuffer(b"".join(batch.column(k).to_pylist())).reshape(batch.num_rows, -1)
                    for k in (2, 3)
                )
                near = np.einsum("ij,ij->i", one, other) >= cosine
                yield batch.select([0, 1]).filter(pa.array(near))

    a = nodes.select(F.col("node").alias("a"), F.col("unit").alias("unit_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("unit").alias("unit_b"))
    return (
        pairs.join(a, "a")
        .join(b, "b")
        .select("a", "b", "unit_a", "unit_b")
        .mapInArrow(rerank, "a long, b long")
    )


def dedup_vectors(
    vectors: DataFrame,
    embedding: str = "embedding",
    vec_id: str = "vec_id",
    cosine: float = COSINE,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of ``vectors``: its links, its component, whether it stays.

    Columns ``vec_id, n_links, component_id, kept``. Vectors that are null, zero or
    hold null or non-finite components link with nothing, nor do those of another
    length than most of the sample has. Equal vectors are one node, whose copies
    count as links of each other. Null ids stay null and come last in a component;
    rows that repeat count each. Other columns are not read. An empty table gives an
    empty result.

    Pairs of a large group of different near copies are all links, and ``n_links``
    is their number, so their count grows with the square of the group; they are
    rows of joins that Spark splits. Everything else is linear.
    """
    picked = [
        r[0]
        for r in vectors.where(F.col(embedding).isNotNull())
        .select(F.col(embedding).cast("array<double>").alias("v"))
        .orderBy(F.xxhash64("v"))
        .limit(sample)
        .collect()
    ]
    lengths = [len(v) for v in picked if v]
    size = max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 1
    units, good = unit_rows(picked, size)
    rotation = fit_rotation(units[good]) if good.any() else np.eye(size)
    rows = coded(vectors, size, rotation, embedding, vec_id)

    order = F.struct(F.col("vec_id").isNull().alias("no_id"), "vec_id")
    groups = (
        rows.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min(ROW).alias("node"), F.min(order).alias("least"), F.count("*").alias("copies"))
    )
    groups = written(groups, "vector-groups")
    nodes = written(
        groups.join(rows.select(F.col(ROW).alias("node"), "code", "unit"), "node").select(
            "node", "code", "unit"
        ),
        "vector-nodes",
    )
    links = written(reranked(candidates(nodes), nodes, cosine), "vector-links")
    both = links.union(links.select("b", "a")).toDF("node", "other")
    copies = groups.select(F.col("node").alias("other"), "copies")
    degrees = both.join(copies, "other").groupBy("node").agg(F.sum("copies").alias("others"))
    named = (
        groups.join(components(links), "node", "left")
        .join(degrees, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    least = named.groupBy("label").agg(F.min("least").alias("component"))
    found = named.join(least, "label").select(
        "digest",
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        "component",
    )
    lone = F.col("component").isNull()
    component = F.when(lone, F.col("vec_id")).otherwise(F.col("component.vec_id"))
    return rows.join(found, "digest", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
