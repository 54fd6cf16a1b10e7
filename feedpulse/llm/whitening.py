"""Whitening of embeddings by FEAST contour integration.

The covariance of all distinct vectors is a sum over Spark tasks and as large as the
square of their dimension, whatever the rows. Its leading eigenvectors are found on the
driver:

* An inertia count, the signs of an LDL' factorisation of ``V - s I``, tells how many
  eigenvalues are below ``s``. By bisection it gives a bound above which the wanted ones
  lie, and cuts what is above into intervals of few eigenvalues each.
* For each interval the projector onto its eigenvectors is the integral of the resolvent
  along a circle around it: Gauss-Legendre points on the upper half, a solve of the
  complex shifted covariance at each. A block of vectors goes through it, Rayleigh-Ritz
  extracts eigenpairs from what comes out, and this repeats until residuals vanish.
* Each interval must yield as many eigenvalues as its inertia counts say.

Rows are then projected where they lie.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm.common import written

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
#: Eigenvalues in an interval, points on its half circle, rounds until it must be found.
SLICE = 6
POINTS = 8
REACH = 1.4
ROUNDS = 30
SEED = 1303
#: An eigenvalue below this share of the trace counts as none: rounding made it.
LEAST_SHARE = 1e-12


def count_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are below ``shift``: negative ones of ``LDL' = matrix - shift I``.

    With complete pivoting of Bunch and Parlett; a block of two has one negative
    eigenvalue.
    """
    a = matrix - shift * np.eye(len(matrix))
    negative = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        off = np.abs(np.triu(a, 1))
        k = int(diagonal.argmax())
        i, j = divmod(int(off.argmax()), len(a))
        if diagonal[k] >= 0.6404 * off[i, j]:  # (1 + sqrt(17)) / 8, which bounds growth
            pivot = [k]
            negative += a[k, k] < 0
        else:
            pivot = [i, j]
            negative += 1
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        block = a[np.ix_(pivot, pivot)]
        if not np.any(block):  # all that is left is zero
            break
        cross = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - cross @ np.linalg.solve(block, cross.T)
        a = (a + a.T) / 2
    return int(negative)


def slices(matrix: np.ndarray, wanted: int, top: float, size: int = SLICE) -> list[tuple]:
    """``(low, high, count)``: intervals up to ``top`` with at least ``wanted`` eigenvalues.

    Points of division lie a little off the middle, where no eigenvalue is by design of
    the data. Eigenvalues that do not part within the rounding stay together.
    """
    least = top * 1e-13
    n = len(matrix)

    def inside(low: float, high: float) -> int:
        return count_below(matrix, high) - count_below(matrix, low)

    low, high = -top * 1e-3, top  # above ``low`` there are enough, above ``high`` too few
    while high - low > least and n - count_below(matrix, low) > wanted:
        middle = low + (high - low) * 0.49731
        if n - count_below(matrix, middle) >= wanted:
            low = middle
        else:
            high = middle
    found, todo = [], [(low, top, inside(low, top))]
    while todo:
        a, b, count = todo.pop()
        if not count:
            continue
        if count <= size or b - a <= least:
            found.append((a, b, count))
            continue
        middle = a + (b - a) * 0.49731
        above = inside(middle, b)
        todo.extend([(a, middle, count - above), (middle, b, above)])
    return found


def interval_pairs(matrix: np.ndarray, low: float, high: float, count: int):
    """Eigenvalues and unit eigenvectors in an interval that holds ``count`` of them.

    The block has room for those just outside as well, which the integral damps least;
    then a round takes off a factor of about ``REACH ** (2 * POINTS)``.
    """
    n = len(matrix)
    middle, radius = (low + high) / 2, (high - low) / 2
    edges = middle + radius * REACH, middle - radius * REACH
    block = min(n, count_below(matrix, edges[0]) - count_below(matrix, edges[1]) + 2)
    points, shares = np.polynomial.legendre.leggauss(POINTS)
    angles = np.pi / 2 * (1 - points)
    vectors = np.random.default_rng(SEED).standard_normal((n, block))
    scale = np.abs(matrix).sum(1).max()
    before = np.inf
    for _ in range(ROUNDS):
        projected = np.zeros((n, block))
        for share, angle in zip(shares, angles):
            turn = radius * np.exp(1j * angle)
            solved = np.linalg.solve((middle + turn) * np.eye(n) - matrix, vectors.astype(complex))
            projected += share / 2 * (turn * solved).real
        basis, _ = np.linalg.qr(projected)
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ turned
        residual = np.abs(matrix @ vectors - vectors * values).max(0)
        # Directions that the projector sends to nothing come out as any value, also one
        # in the interval; they are no eigenpairs and show it.
        within = (values >= low) & (values <= high) & (residual <= 1e-9 * scale)
        if within.sum() == count:
            worst = residual[within].max()
            # As good as it gets: down to rounding, and a round no longer halves it.
            if worst <= 1e-14 * scale and (worst == 0 or worst * 2 > before):
                return values[within], vectors[:, within]
            before = worst
    raise RuntimeError(
        f"{int(within.sum())} of {count} eigenvalues found between {low} and {high}"
    )


def leading_components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their unit eigenvectors as columns.

    Fewer than ``wanted`` where the rest is zero.
    """
    trace = float(np.trace(matrix))
    if trace <= 0:
        return np.empty(0), np.empty((len(matrix), 0))
    top = float(np.abs(matrix).sum(1).max()) * 1.0173
    wanted = min(wanted, len(matrix) - count_below(matrix, trace * LEAST_SHARE))
    values, vectors = zip(*(interval_pairs(matrix, *part) for part in slices(matrix, wanted, top)))
    values, vectors = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


def fixed_point(vector: str | Column) -> Column:
    """The entries of ``vector`` as whole numbers of 1/64, shifted to be positive."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)


def usable(vector: str) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""

    def finite(c: Column) -> Column:
        return F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False))

    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def matrix_of(column) -> np.ndarray:
    """The list column of a batch as rows of a matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def summed(df: DataFrame, parts: Callable[[np.ndarray], np.ndarray], rows: int, width: int):
    """The sum over all batches of ``x`` of the matrix that ``parts`` makes of one.

    Each task sends its sum, row by row; rows of the same number are added in one
    place, so that the driver gets one matrix however many tasks there are.
    """

    def of_rows(matrix: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(matrix), pa.int32()),
                pa.array([v.tolist() for v in matrix.values()], pa.list_(pa.float64())),
            ],
            names=["i", "part"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows, width))
        for batch in batches:
            if batch.num_rows:
                total += parts(matrix_of(batch.column(0)))
        yield of_rows(dict(enumerate(total)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), matrix_of(batch.column(1))):
                total[i] = total[i] + part if i in total else part
        yield of_rows(total)

    schema = "i int, part array<double>"
    merged = df.select("x").mapInArrow(task, schema).repartition("i").mapInArrow(merge, schema)
    out = np.zeros((rows, width))
    for i, part in merged.collect():  # as many rows as the matrix has
        out[i] = part
    return out


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` in whole numbers, which do not round."""
    if np.abs(x).max(initial=0) * float(n) >= 2**62:
        raise OverflowError("n * x does not fit a long")
    return n * x - sums


def whiten(
    df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable row of ``df`` and component, numbered by falling variance.

    Columns ``vec_id, component, n, deviation, whitened, explained, identity_error``.
    Rows whose vector is null, empty or holds null or non-finite entries are dropped;
    null ids and repeated rows stay, and equal vectors count once in the covariance.
    Components of no variance are left out: of one distinct vector, or none, nothing
    comes. Vectors of several lengths raise a ``ValueError``, sums beyond 64 bits an
    ``OverflowError``. Other columns are not read.
    """
    spark = df.sparkSession
    rows = written(
        df.where(usable(vector)).select(
            F.col(vec_id).cast("long").alias("vec_id"), fixed_point(vector).alias("x")
        ),
        "fixed-point",
    )
    out = (
        "vec_id long, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    shortest, longest = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if shortest != longest:
        raise ValueError(f"vectors of {shortest} to {longest} entries")
    if shortest is None:
        return spark.createDataFrame([], out)
    size = shortest
    fit = written(rows.select("x").distinct(), "fit-vectors")
    n = fit.count()
    each = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v")).collect()
    sums = np.zeros(size, np.int64)
    for i, total in each:
        sums[i] = total

    def products(x: np.ndarray) -> np.ndarray:
        off = centred(x, n, sums) / n
        return off.T @ off

    covariance = summed(fit, products, size, size) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_components(covariance, components)
    if not len(values):
        return spark.createDataFrame([], out)
    turn = vectors / np.sqrt(values)
    explained = values / np.trace(covariance)
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        white = centred(x, n, sums) / n @ turn
        return np.vstack([white.T @ white, white.sum(0)])

    of_white = summed(fit, moments, k + 1, k) / n
    mean = of_white[k]
    error = float(np.abs(of_white[:k] - np.outer(mean, mean) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            off = centred(matrix_of(batch.column(1)), n, sums)
            if (off.astype(float) ** 2).sum(1).max() >= 2**63 * 0.999:
                raise OverflowError("a deviation does not fit a long")
            white = (off / n) @ turn
            count = len(off)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(count), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, n)),
                    pa.array(np.repeat((off**2).sum(1), k)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(count * k, error)),
                ],
                names=[name.split()[0] for name in out.split(", ")],
            )

    return rows.mapInArrow(project, out)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
