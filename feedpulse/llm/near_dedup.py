"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of half keys are made for each document, each half key from
``ROWS`` minimum hashes. The keys of the hash tables are all pairs of a half key of
the one collection with one of the other: ``SIDE`` squared tables from ``2 * SIDE``
half keys, so the number of hash functions is about the root of what as many
independent tables would take. At a similarity of 0.75 a pair shares a table with
probability ``(1 - (1 - 0.75 ** ROWS) ** SIDE) ** 2`` = 0.9997, and above it sooner.

Half keys that one document alone has can't be part of a shared table, so they go
before any pair is formed: most documents of a corpus make no key at all.

Documents with equal shingle sets are one node. Of the nodes that share a table with
others, each shingle is counted; one that a single node has is in no intersection, so
the others bound the similarity of a node to any other. Nodes and pairs under that
bound go, exactly and before pairs are made: of a group of copies changed at random
places only those stay that can have a link.

In a table, nodes are first compared with one centre only, the node with the least
share of shingles of its own; links found make components. Nodes of a table that are
in different components may still be linked. Their shingles are put in one order,
rarest first. Two similar sets share a shingle among the first quarter of either, at
places that leave enough behind them, so only nodes that meet there are compared:
copies changed at different places don't. Nodes of the largest component at a shingle
are left out among themselves. So no group is expanded into all pairs, and no pair
is left out whose link could still join two components. Every link is confirmed on
the full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedpulse.llm.common import (
    ROW,
    components,
    documents,
    keyed_documents,
    keyed_rows,
    small_batches,
    text_or_empty,
    written,
)

WORDS = 5
PERCENT = 75
ROWS = 3
SIDE = 16
HASHES = 2 * SIDE * ROWS
SEED = 7041
#: Pairs that agree in fewer of the ``HASHES`` minimum hashes are not confirmed on
#: the full sets: 3.9 standard deviations below what a similarity of 0.75 gives.
SKETCH_LEAST = 56


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words, A-Z in lower case.

    Words are what ASCII white space separates. A text of fewer words is one run
    of all of them, one without words has none.
    """
    import xxhash

    split = text.encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not split:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, len(split))
    width = min(words, len(hashes))
    n = len(hashes) - width + 1
    runs = np.full(n, width, np.uint64)
    for k in range(width):
        runs = mixed(runs + hashes[k : k + n])
    return np.unique(runs)


def factors() -> np.ndarray:
    odd = np.random.default_rng(SEED).integers(0, 2**63, HASHES, np.uint64)
    return odd * np.uint64(2) + np.uint64(1)


def minimum_hashes(own: np.ndarray, by: np.ndarray) -> np.ndarray:
    least = np.full(len(by), np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(own), 2048):
        np.minimum(least, (own[first : first + 2048, None] * by).min(0), out=least)
    return least


def half_keys(least: np.ndarray) -> np.ndarray:
    """``2 * SIDE`` numbers; the first half is one collection, the second the other."""
    keys = np.arange(2 * SIDE, dtype=np.uint64)
    for row in least.reshape(2 * SIDE, ROWS).T:
        keys = mixed(keys + row)
    return keys.view(np.int64)


def signatures(rows: DataFrame) -> DataFrame:
    """``(row, doc_id, n, digest, halves, sketch)`` of ``rows (row, doc_id, text)``, stored.

    ``digest`` is that of the shingle set; it is null, as are the others, where the
    set is empty.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = factors()
        for batch in batches:
            sizes, digests, halves, sketches = [], [], [], []
            for value in batch.column(2):
                own = shingles(value.as_py())
                sizes.append(len(own))
                if len(own):
                    least = minimum_hashes(own, by)
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    halves.append(half_keys(least))
                    sketches.append(mixed(least).astype(np.uint8).tobytes())
                else:
                    digests.append(None)
                    halves.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(halves, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                names=[ROW, "doc_id", "n", "digest", "halves", "sketch"],
            )

    return written(
        rows.select(ROW, "doc_id", "text").mapInArrow(
            sign,
            f"{ROW} long, doc_id long, n long, digest binary, halves array<long>, sketch binary",
        ),
        "signatures",
    )


def table_keys(nodes: DataFrame) -> DataFrame:
    """``(key, node, n)``: the tables in which a node may meet another.

    Half keys that only one node has are dropped first; the number of the half key
    is part of its hash, so the collections don't mix.
    """
    halves = nodes.select("node", "n", F.posexplode("halves").alias("i", "half"))
    shared = written(
        halves.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half"), "halves"
    )
    both = (
        halves.join(shared, "half")
        .groupBy("node", "n")
        .agg(
            F.collect_list(F.when(F.col("i") < SIDE, F.col("half"))).alias("one"),
            F.collect_list(F.when(F.col("i") >= SIDE, F.col("half"))).alias("other"),
        )
    )
    halved = both.select("node", "n", "other", F.explode("one").alias("u"))
    return halved.select("node", "n", "u", F.explode("other").alias("v")).select(
        F.xxhash64("u", "v").alias("key"), "node", "n"
    )


def similar_sketches(pairs: DataFrame, nodes: DataFrame, least: int = SKETCH_LEAST) -> DataFrame:
    """Pairs ``(a, b)`` whose sizes allow a link and whose minimum hashes mostly agree."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = (
                    np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, HASHES)
                    for k in (2, 3)
                )
                near = pa.array((one == other).sum(1) >= least)
                yield batch.select([0, 1]).filter(near)

    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    return (
        pairs.join(a, "a")
        .join(b, "b")
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT)
        .select("a", "b", "s_a", "s_b")
        .mapInArrow(agree, "a long, b long")
    )


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are links on their full shingle sets, stored.

    The centre of a large group is in many pairs; they are rows of a plain sort-merge
    join, which Spark splits.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            links = []
            for a, one, other in zip(batch.column(0), batch.column(2), batch.column(3)):
                if a != last:
                    last, own = a, shingles(one.as_py())
                its = shingles(other.as_py())
                both = np.intersect1d(own, its, assume_unique=True).size
                links.append(100 * both >= PERCENT * (len(own) + len(its) - both))
            yield batch.select([0, 1]).filter(pa.array(links, pa.bool_()))

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return written(
        pairs.join(b, "b")
        .join(a, "a")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(compare, "a long, b long"),
        "links",
    )


def exploded(texts: DataFrame) -> DataFrame:
    """``(node, shingle)`` of every shingle."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = shingles(text.as_py()).view(np.int64)
                for first in range(0, len(own), 10_000):
                    some = own[first : first + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), node)), pa.array(some)],
                        names=["node", "shingle"],
                    )

    return texts.select("node", "text").mapInArrow(explode, "node long, shingle long")


def not_alone(texts: DataFrame) -> DataFrame:
    """``(node, n, m)`` of nodes that can have a link: ``m`` shingles another node has too."""
    alone = (
        exploded(texts)
        .groupBy("shingle")
        .agg(F.count("*").alias("c"), F.min("node").alias("node"))
        .where("c = 1")
        .groupBy("node")
        .agg(F.count("*").alias("alone"))
    )
    return (
        texts.select("node", "n")
        .join(alone, "node", "left")
        .select("node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("m"))
        .where(F.col("m") * 100 >= F.col("n") * PERCENT)
    )


def prefixes(texts: DataFrame) -> DataFrame:
    """``(key, node, n, place)``: the shingles by which a node may meet another.

    ``place`` counts from 0 in the order of shingles, rarest first; those that one
    node alone has come before all and need no row. Beyond the first quarter no
    shingle can be the first that two similar sets share.
    """
    rows = exploded(texts)
    counts = written(rows.groupBy("shingle").agg(F.count("*").alias("c")).where("c > 1"), "counts")
    shared = rows.join(counts, "shingle")
    order = Window.partitionBy("node").orderBy("c", "shingle")
    ranked = shared.select(
        "node",
        "shingle",
        F.row_number().over(order).alias("rank"),
        F.count("*").over(Window.partitionBy("node")).alias("total"),
    )
    return (
        ranked.join(texts.select("node", "n"), "node")
        .select(
            F.col("shingle").alias("key"),
            "node",
            "n",
            (F.col("n") - F.col("total") + F.col("rank") - 1).alias("place"),
        )
        .where((F.col("n") - F.col("place")) * 100 >= F.col("n") * PERCENT)
    )


def possible(n_a: str, m_a: str, n_b: str, m_b: str) -> Column:
    """Whether two nodes can be similar enough, by their sizes and shared shingles."""
    both = F.least(m_a, m_b)
    return both * 100 >= (F.col(n_a) + F.col(n_b) - both) * PERCENT


def star_pairs(entries: DataFrame) -> DataFrame:
    """One pair per node: with the centre of most of its tables.

    Centres are found with map-side combine.
    """
    first = F.struct((F.col("m") / F.col("n")).alias("share"), (-F.col("node")).alias("minus"), "n", "m")
    centres = (
        entries.groupBy("key")
        .agg(F.max(first).alias("top"))
        .select(
            "key",
            (-F.col("top.minus")).alias("a"),
            F.col("top.n").alias("n_a"),
            F.col("top.m").alias("m_a"),
        )
    )
    met = entries.join(written(centres, "centres"), "key").where(
        (F.col("node") != F.col("a")) & possible("n", "m", "n_a", "m_a")
    )
    return met.groupBy("node").agg(F.mode("a", True).alias("a")).select("a", F.col("node").alias("b"))


def mixed_keys(entries: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``entries`` with their labels, and the keys that nodes of several labels have.

    Of such a key, ``major`` is the label of most of its nodes.
    """
    named = entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counts = named.groupBy("key", "label").agg(F.count("*").alias("c"))
    keys = (
        counts.groupBy("key")
        .agg(F.count("*").alias("labels"), F.max(F.struct("c", "label")).alias("most"))
        .where("labels > 1")
        .select("key", F.col("most.label").alias("major"))
    )
    return named, written(keys, "mixed-keys")


def open_texts(entries: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts of the nodes that share a table with a node of another component."""
    named, keys = mixed_keys(entries, labels)
    return texts.join(named.join(keys, "key", "left_semi").select("node").distinct(), "node")


def open_pairs(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different components that meet in their prefixes, once each.

    At each shingle the component with most nodes is only compared with the others.
    What follows the meeting, on the side that has less, must suffice for a link.
    """
    named, keys = mixed_keys(entries, labels)
    named = named.join(keys, "key")
    few = named.where("label != major").select(
        "key", *[F.col(c).alias(f"few_{c}") for c in ("node", "n", "place", "label")]
    )
    left = F.least(F.col("few_n") - F.col("few_place"), F.col("n") - F.col("place"))
    pairs = few.join(named, "key").where(
        (F.col("few_label") != F.col("label"))
        & ((F.col("label") == F.col("major")) | (F.col("few_node") < F.col("node")))
        & (left * 100 >= (F.col("few_n") + F.col("n") - left) * PERCENT)
    )
    return pairs.select(
        F.least("few_node", "node").alias("a"), F.greatest("few_node", "node").alias("b")
    ).distinct()


def dedup_near(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: set size, component, whether it stays.

    Columns ``_llm_row, doc_id, n_shingles, component_id, kept, first``. ``kept``
    is ``doc_id = component_id``; ``first`` is true for exactly one row of each
    component, also where ids are null (they come last) or repeated. Null and empty
    texts and such without words have no shingles and are components of their own.
    Other columns are not read. ``row`` names a row key that is stored with ``docs``;
    without one, ids and texts are stored here, as texts of candidates are read again.
    """
    own_id = F.col(doc_id).cast("long").alias("doc_id")
    own_text = text_or_empty(text).alias("text")
    if row is None:
        rows = keyed_rows(docs, own_id, own_text)
    else:
        rows = docs.select(F.col(row).alias(ROW), own_id, own_text)
    with small_batches(docs.sparkSession):
        return _dedup_near(rows)


def _dedup_near(rows: DataFrame) -> DataFrame:
    signed = signatures(rows)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(ROW).alias("row"))
    groups = written(
        signed.where("n > 0")
        .groupBy("digest")
        .agg(
            F.min(ROW).alias("node"),
            F.min(order).alias("least"),
            F.first("n").alias("n"),
            F.first("halves").alias("halves"),
            F.first("sketch").alias("sketch"),
        ),
        "nodes",
    )
    sketches = groups.select("node", "n", "sketch")
    keys = written(table_keys(groups), "table-keys")
    tables = written(
        keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "tables"
    )
    met = written(keys.join(tables, "key"), "met")
    nodes = met.select(F.col("node").alias(ROW), "n").distinct()
    texts = written(
        rows.select(ROW, "text")
        .join(nodes, ROW)
        .select(F.col(ROW).alias("node"), "n", "text"),
        "texts",
    )
    entries = written(met.drop("n").join(not_alone(texts), "node"), "entries")
    links = confirmed(similar_sketches(star_pairs(entries), sketches), texts)
    labels = components(links)
    still_open = written(open_texts(entries, labels, texts), "open-texts")
    met = written(prefixes(still_open), "prefixes")
    pairs = written(similar_sketches(open_pairs(met, labels), sketches), "open-pairs")
    if not pairs.isEmpty():
        links = links.union(confirmed(pairs, texts))
        labels = components(links)

    named = groups.join(labels, "node", "left").select(
        "digest", "least", F.coalesce("label", "node").alias("label")
    )
    firsts = written(named.groupBy("label").agg(F.min("least").alias("component")), "components")
    found = written(named.join(firsts, "label").select("digest", "component"), "found")
    lone = F.col("component").isNull()
    return signed.join(found, "digest", "left").select(
        ROW,
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(lone, F.col("doc_id")).otherwise(F.col("component.doc_id")).alias("component_id"),
        (lone | F.col("doc_id").eqNullSafe(F.col("component.doc_id"))).alias("kept"),
        F.coalesce(F.col(ROW) == F.col("component.row"), F.lit(True)).alias("first"),
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_near(documents(spark, sf_dir)).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def keep_first_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each component, with its columns."""
    rows = keyed_documents(docs)
    own = rows.select(ROW, "doc.doc_id", "doc.text")
    first = dedup_near(own, row=ROW).where("first").select(ROW)
    return rows.join(first, ROW, "left_semi").select("doc.*")
