"""Ranked lexical search over a document FP-tree.

Documents are reduced to the terms that items ask for. The term vector of a document
is written in one order of terms, most frequent first, so documents with common terms
share the head of their paths. Rows are dealt to tasks in ranges of that order and lie
sorted there: a task holds whole branches of the tree.

A task cuts its rows into trees of a bounded number of postings. A node of a tree
knows, for each term below it, the largest tf, and the smallest m of its documents; the
score of an item with those is a bound on all documents below. An item is searched
depth first, best bound first; a branch whose bound is under the item's tenth score so
far is not entered. The ten best of each task are merged by a window with a limit.

Nodes with few documents, and nodes with most documents of their parent, are not kept;
their children hang on the node above. So a document is below as many nodes as the
logarithm of the tree's size at most, whatever the paths look like.

Items are taken in blocks of bounded size, against all documents each. What reaches the
driver is a block of items and the document frequency of its terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedpulse.llm.common import documents, row_key, small_batches, text_or_empty, written

TOP = 10
#: Bytes of item texts in a block, and postings in a tree.
BLOCK_BYTES = 4 << 20
TREE_POSTINGS = 1_000_000
#: A node of fewer documents is not kept.
LEAF = 16
#: Terms of a path that deal rows to tasks: bounds of ranges go to the driver.
HEAD = 12

# Bytes of words; all others part them.
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256)
)

VECTOR = "row long, doc_id long, n long, terms array<int>, tfs array<int>, docs long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats, A-Z in lower case."""
    return text.translate(_FOLDED).split()


def item_blocks(items: DataFrame, text: str, item_id: str, size: int) -> Iterator[list]:
    """Lists of ``(item_id, distinct terms)`` of ``size`` bytes at most, or of one item."""
    block, held = [], 0
    rows = items.select(F.col(item_id).cast("long"), text_or_empty(text))
    for own_id, own_text in rows.toLocalIterator():
        own = own_text.encode()
        cost = len(own) + 64  # an item without text takes room as well
        if block and held + cost > size:
            yield block
            block, held = [], 0
        block.append((own_id, sorted(set(terms_of(own)))))
        held += cost
    if block:
        yield block


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Term vectors over ``vocabulary`` of the documents that have some of it, stored.

    Each task adds one row with ``docs`` set: its number of documents with terms, of
    their terms with repeats (``n``), and of documents with each term (``tfs``).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, frequency = vocabulary.get, np.zeros(len(vocabulary), np.int32)
        n_docs = n_terms = 0

        def rows_of(columns) -> pa.RecordBatch:
            kinds = (
                pa.int64(),
                pa.int64(),
                pa.int64(),
                pa.list_(pa.int32()),
                pa.list_(pa.int32()),
                pa.int64(),
            )
            names = ["row", "doc_id", "n", "terms", "tfs", "docs"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            out = ([], [], [], [], [], [])
            for row, doc_id, text in zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                batch.column(2).cast(pa.binary()),
            ):
                words = terms_of(text.as_py())
                if not words:
                    continue
                n_docs += 1
                n_terms += len(words)
                known = np.array([get(w, -1) for w in words], np.int32)
                own, tf = np.unique(known[known >= 0], return_counts=True)
                if len(own):
                    frequency[own] += 1
                    values = (row, doc_id, len(words), own, tf.astype(np.int32), None)
                    for column, value in zip(out, values):
                        column.append(value)
            yield rows_of(out)
        own = np.flatnonzero(frequency).astype(np.int32)
        yield rows_of(([None], [None], [n_terms], [own], [frequency[own]], [n_docs]))

    return written(docs.mapInArrow(count, VECTOR), "term-vectors")


def weights(n_docs: int, frequency: np.ndarray) -> np.ndarray:
    """The weight of each term by the number of documents that hold it."""
    return np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in frequency],
        np.int64,
    )


def impact(tf: np.ndarray, m) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def paths(vectors: DataFrame, rank: np.ndarray) -> DataFrame:
    """``vectors`` as ``(row, doc_id, n, path, tfs)``: terms by rank, least first."""

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat = rank[lists.flatten().to_numpy()]
            tfs = batch.column(4).flatten().to_numpy()
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            by = np.lexsort((flat, np.repeat(np.arange(len(sizes)), sizes)))
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.ListArray.from_arrays(offsets, pa.array(flat[by], pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs[by], pa.int32())),
                ],
                names=["row", "doc_id", "n", "path", "tfs"],
            )

    return vectors.select("row", "doc_id", "n", "terms", "tfs").mapInArrow(
        order, "row long, doc_id long, n long, path array<int>, tfs array<int>"
    )


class Tree:
    """The FP-tree of documents given in path order.

    ``pages[k]`` lists the children of node ``k``: a number of a document, or the
    complement of a node's number. The terms of each child and their impacts (exact
    for a document, bounds for a node) lie one after the other, from ``starts`` on.
    """

    def __init__(self, doc_ids, m, offsets, terms, tfs, n_terms: int):
        self.doc_ids, self.m, self.offsets, self.terms, self.tfs = doc_ids, m, offsets, terms, tfs
        self.exact = impact(tfs, np.repeat(m, np.diff(offsets)))
        self.shared = self._shared()
        self.highest = np.zeros(n_terms, np.int64)
        self.pages = []
        todo = [(0, len(m))]
        nodes = 1
        while len(self.pages) < nodes:
            ranges = self._children(*todo[len(self.pages)])
            inner = [r for r in ranges if r[1] - r[0] >= LEAF]
            self.pages.append(self._page(ranges, nodes))
            todo.extend(inner)
            nodes += len(inner)

    def _shared(self) -> np.ndarray:
        """How many terms each path has in common with the one before it."""
        shared = np.zeros(len(self.m), np.int64)
        for k in range(1, len(self.m)):
            before = self.terms[self.offsets[k - 1] : self.offsets[k]]
            own = self.terms[self.offsets[k] : self.offsets[k + 1]]
            size = min(len(before), len(own))
            differ = np.flatnonzero(before[:size] != own[:size])
            shared[k] = differ[0] if len(differ) else size
        return shared

    def _children(self, first: int, last: int) -> list[tuple[int, int]]:
        """Ranges of documents: branches to keep, or few documents to hang here."""
        found, todo = [], [(first, last)]
        while todo:
            a, b = todo.pop()
            if b - a < LEAF or 2 * (b - a) <= last - first:
                found.append((a, b))
                continue
            inside = self.shared[a + 1 : b]
            cuts = np.flatnonzero(inside == inside.min()) + a + 1
            edges = [a, *cuts.tolist(), b]
            if len(edges) - 1 == b - a:  # nothing but single documents
                found.extend((k, min(k + LEAF - 1, b)) for k in range(a, b, LEAF - 1))
            else:
                todo.extend(zip(edges, edges[1:]))
        return found

    def _page(self, ranges: list[tuple[int, int]], nodes: int):
        children, terms, impacts = [], [], []
        for a, b in ranges:
            low, high = self.offsets[a], self.offsets[b]
            if b - a < LEAF:
                for k in range(a, b):
                    children.append(k)
                    terms.append(self.terms[self.offsets[k] : self.offsets[k + 1]])
                impacts.append(self.exact[low:high])
                continue
            np.maximum.at(self.highest, self.terms[low:high], self.tfs[low:high])
            below = np.flatnonzero(self.highest)
            terms.append(below)
            impacts.append(impact(self.highest[below], self.m[a:b].min()))
            self.highest[below] = 0
            children.append(~nodes)
            nodes += 1
        starts = np.cumsum([0, *map(len, terms)])[:-1]
        return np.array(children), starts, np.concatenate(terms), np.concatenate(impacts)

    def search(self, weight: np.ndarray, best: list[tuple], top: int) -> list[tuple]:
        """``best``, as ``(-score, no id, id)`` in order, with what is better here.

        ``weight`` is that of each term, 0 for those the item does not have.
        """
        todo = [(np.inf, 0)]
        while todo:
            bound, node = todo.pop()
            least = -best[-1][0] if len(best) == top else 1
            if bound < least:
                continue
            children, starts, terms, impacts = self.pages[node]
            scores = np.add.reduceat(weight[terms] * impacts, starts)
            good = np.flatnonzero(scores >= least)
            is_doc = children[good] >= 0
            docs, reached = children[good[is_doc]], scores[good[is_doc]]
            if len(docs):
                ids, no_id = self.doc_ids
                order = np.lexsort((ids[docs], no_id[docs], -reached))[:top]
                new = zip(
                    (-reached[order]).tolist(),
                    no_id[docs[order]].tolist(),
                    ids[docs[order]].tolist(),
                )
                best = sorted([*best, *new])[:top]
            inner, bounds = ~children[good[~is_doc]], scores[good[~is_doc]]
            order = np.argsort(bounds, kind="stable")
            todo.extend(zip(bounds[order].tolist(), inner[order].tolist()))
        return best


def search_block(
    placed: DataFrame,
    items: list[tuple[int, np.ndarray]],
    weight: np.ndarray,
    n_docs: int,
    n_terms: int,
    top: int,
    postings: int = TREE_POSTINGS,
) -> DataFrame:
    """``(item, doc_id, score)``: the best of each task for each item of a block.

    ``placed`` is sorted by path; ``items`` are a number and the ranks of the terms,
    ``weight`` goes by rank.
    """

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[Tree]:
        held, size = [], 0
        for batch in batches:
            sizes = batch.column(3).value_lengths().to_numpy(zero_copy_only=False)
            first = 0
            for k, own in enumerate(sizes):
                size += int(own)
                if size >= postings:
                    held.append(batch.slice(first, k + 1 - first))
                    yield planted(held)
                    held, size, first = [], 0, k + 1
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if held:
            yield planted(held)

    def planted(held: list[pa.RecordBatch]) -> Tree:
        table = pa.Table.from_batches(held).combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        paths = table.column("path").combine_chunks()
        n = table.column("n").to_numpy()
        m = 10 + (90 * n * n_docs) // n_terms
        sizes = paths.value_lengths().to_numpy(zero_copy_only=False)
        return Tree(
            (ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)),
            m,
            np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))),
            paths.flatten().to_numpy(),
            table.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64),
            len(weight),
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: [] for number, _ in items}
        asked = np.zeros(len(weight), np.int64)
        for tree in trees(batches):
            for number, ranks in items:
                asked[ranks] = weight[ranks]
                best[number] = tree.search(asked, best[number], top)
                asked[ranks] = 0
        for number, found in best.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * len(found), pa.int64()),
                    pa.array([None if no else i for _, no, i in found], pa.int64()),
                    pa.array([-s for s, _, _ in found], pa.int64()),
                ],
                names=["item", "doc_id", "score"],
            )

    return placed.select("row", "doc_id", "n", "path", "tfs").mapInArrow(
        search, "item long, doc_id long, score long"
    )


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
    postings: int = TREE_POSTINGS,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` best documents of each item.

    Null and empty texts have no terms: such a document is not counted and never found,
    such an item has no rows, nor has one whose terms no document holds. Equal scores
    go by ascending ``doc_id``, null last. Repeated documents are ranked each. Items
    with the same id are items of their own. Other columns are not read. Where either
    table is empty the result is.
    """
    spark = docs.sparkSession
    keyed = row_key(docs).select(
        "_llm_row", F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")
    )
    found, number = None, 0
    with small_batches(spark):
        for block in item_blocks(items, item_text, item_id, block_bytes):
            vocabulary = {t: k for k, t in enumerate(sorted({t for _, own in block for t in own}))}
            if not vocabulary:
                continue
            vectors = restricted_vectors(keyed, vocabulary)
            totals = vectors.where("docs IS NOT NULL")
            n_docs, n_terms = totals.agg(F.sum("docs"), F.sum("n")).first()
            counts = (
                totals.select(F.explode(F.arrays_zip("terms", "tfs")).alias("e"))
                .groupBy("e.terms")
                .agg(F.sum("e.tfs"))
                .collect()  # a row per term of the block
            )
            if not counts:
                continue
            frequency = np.zeros(len(vocabulary), np.int64)
            for term, df in counts:
                frequency[term] = df
            by_frequency = np.argsort(-frequency, kind="stable")
            rank = np.empty(len(vocabulary), np.int32)
            rank[by_frequency] = np.arange(len(vocabulary), dtype=np.int32)
            weight = weights(n_docs, frequency)[by_frequency]
            asked = [
                (number + k, rank[[vocabulary[t] for t in own]])
                for k, (_, own) in enumerate(block)
                if own
            ]
            parts = -(-int(frequency.sum()) // postings)
            placed = (
                paths(vectors.where("docs IS NULL"), rank)
                .repartitionByRange(parts, F.slice("path", 1, HEAD), "row")
                .sortWithinPartitions("path", "row")
            )
            best = search_block(placed, asked, weight, n_docs, n_terms, top, postings)
            best = written(best, "best")
            order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
            best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            ids = [(number + k, own_id) for k, (own_id, _) in enumerate(block)]
            names = spark.createDataFrame(ids, "item long, item_id long")
            best = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
            found = best if found is None else found.union(best)
            number += len(block)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return rank_documents(documents(spark, sf_dir), items)


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
total AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM d),
m AS (
  SELECT doc_id, 10 + (90 * n * all_docs) // all_terms AS m FROM d, total),
tf AS (
  SELECT doc_id, term, count(*) AS tf FROM t
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, all_docs),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER)
         AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
