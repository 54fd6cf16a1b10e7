"""Benchmark decontamination by a prefix-filtered set join, in expressions only.

A benchmark item is cut into windows of ``WINDOW`` consecutive words. A window is a set
of shingles of ``WORDS`` words with their places in it. A document must hold *all* of
them, so of the shingles in order of rarity the prefix that two sets have to share is
the single rarest one. Only the places where that shingle stands are candidates. The
place of the shingle gives the start of the window (positional bound), which must lie
in the document with all its words (length bound). The words there are then compared
with those of the window.

How it runs:

1. Texts are split into words once and stored as such, with the row key.
2. Shingles of the documents are met with those of the benchmark; what is met is
   stored, as ``(row, pos, shingle)``. It is the size of the passages shared, not of the
   corpus. Spark broadcasts the benchmark's shingles below its threshold and shuffles
   both sides above it, where it can split a hot shingle.
3. Shingles are counted over the whole corpus for the order of rarity.
4. Candidates are grouped by document, which bounds a group by the words of one text,
   and compared there. Places hit are counted by one sweep over the sorted windows.

Items that share a window are listed once for each distinct *set of items*: a passage
that a third of the documents shares with a third of the items is no pair of each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm.common import ROW, documents, row_key, text_or_empty, written

WINDOW = 10
WORDS = 5
#: Row keys, of 8 bytes, that are sent to all tasks at most.
BROADCAST_ROWS = 1_000_000

# What words are made of, and the letters that are folded.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """The words of ``text``, A-Z in lower case, as an array."""
    return F.array_remove(F.split(F.translate(text, UPPER, UPPER.lower()), NO_WORD), "")


def shingles(words: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words, by place; none where there are fewer words."""
    last = F.size(words) - width
    each = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]),
    )
    return F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, text: str, item_id: str, window: int) -> DataFrame:
    """``(window, words, length, class, item_ids)``: every distinct window, stored.

    ``class`` stands for the set of ``item_ids`` that have the window.
    """
    worded = items.select(
        F.col(item_id).cast("string").alias("item_id"), words_of(text_or_empty(text)).alias("words")
    ).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    placed = worded.select(
        "item_id",
        "words",
        length.alias("length"),
        F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("start"),
    )
    cut = placed.select("item_id", F.slice("words", F.col("start"), F.col("length")).alias("words"))
    grouped = cut.groupBy(F.array_join("words", " ").alias("window")).agg(
        F.first("words").alias("words"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
    )
    return written(
        grouped.select(
            "window",
            "words",
            F.size("words").alias("length"),
            F.md5(F.array_join("item_ids", ",")).alias("class"),
            "item_ids",
        ),
        "windows",
    )


def window_shingles(windows: DataFrame, widths: list[int]) -> DataFrame:
    """``(window, length, class, offset, shingle)``, stored."""
    parts = None
    for width in widths:
        own = windows.where(F.least("length", F.lit(WORDS)) == width).select(
            "window", "length", "class", F.posexplode(shingles(F.col("words"), width))
        )
        parts = own if parts is None else parts.union(own)
    return written(parts.toDF("window", "length", "class", "offset", "shingle"), "window-shingles")


def met_shingles(texts: DataFrame, known: DataFrame, widths: list[int]) -> DataFrame:
    """``(row, n_words, pos, shingle)`` wherever a document has a shingle of a window, stored."""
    words = texts.select(ROW, "n_words", F.split("words", " ").alias("words"))
    parts = None
    for width in widths:
        own = words.where(F.col("n_words") >= width).select(
            ROW, "n_words", F.posexplode(shingles(F.col("words"), width))
        )
        parts = own if parts is None else parts.union(own)
    placed = parts.toDF(ROW, "n_words", "pos", "shingle")
    return written(placed.join(known.select("shingle").distinct(), "shingle", "left_semi"), "met")


def rarest(known: DataFrame, met: DataFrame) -> DataFrame:
    """``(window, length, class, offset, shingle)``: the prefix of each window.

    Windows with a shingle that no document has are nowhere, and go.
    """
    counts = met.groupBy("shingle").agg(F.count("*").alias("c"))
    order = F.struct(F.coalesce("c", F.lit(0)).alias("c"), "offset", "shingle")
    return (
        known.join(counts, "shingle", "left")
        .groupBy("window", "length", "class")
        .agg(F.min(order).alias("least"))
        .where(F.col("least.c") > 0)
        .select("window", "length", "class", "least.offset", "least.shingle")
    )


def candidates(met: DataFrame, prefix: DataFrame) -> DataFrame:
    """``(row, placed)``: the windows each document may hold and where, stored."""
    start = F.col("pos") - F.col("offset")
    return written(
        met.join(prefix, "shingle")
        .where((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .groupBy(ROW)
        .agg(
            F.collect_list(
                F.struct(
                    start.alias("start"), (start + F.col("length")).alias("end"), "window", "class"
                )
            ).alias("placed")
        ),
        "placed",
    )


def covered(hits: Column) -> Column:
    """How many places the ``[start, end)`` of ``hits`` cover, by a sweep in their order."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("until"))
    swept = F.aggregate(
        F.array_sort(hits),
        zero,
        lambda so_far, h: F.struct(
            (
                so_far["n"] + F.greatest(F.lit(0), h["end"] - F.greatest(h["start"], so_far["until"]))
            ).alias("n"),
            F.greatest(so_far["until"], h["end"]).alias("until"),
        ),
        lambda end: end["n"],
    )
    return swept


def confirmed(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """``(row, n_hit, classes)`` of documents that hold a window, word for word, stored.

    Only texts with candidates are shuffled where the list of those is small enough to
    be sent to all tasks; it is counted, and beyond the bound both sides are shuffled.
    """
    rows = placed.select(ROW)
    if placed.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(rows), ROW, "left_semi")
    words = texts.select(ROW, F.split("words", " ").alias("words"))
    held = F.filter(
        "placed",
        lambda p: F.array_join(F.slice(F.col("words"), p["start"] + 1, p["end"] - p["start"]), " ")
        == p["window"],
    )
    hits = words.join(placed, ROW).select(ROW, held.alias("hits")).where(F.size("hits") > 0)
    return written(
        hits.select(
            ROW,
            covered(F.col("hits")).cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["class"]))).alias(
                "classes"
            ),
        ),
        "hits",
    )


def item_lists(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """``(classes, n_items, items_sha256)`` of every distinct set of classes among the hits."""
    members = windows.groupBy("class").agg(F.first("item_ids").alias("item_ids"))
    sets = hits.select("classes").distinct()
    items = (
        sets.select("classes", F.explode("classes").alias("class"))
        .join(members, "class")
        .select("classes", F.explode_outer("item_ids").alias("item_id"))
        .groupBy("classes")
        .agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    )
    return items.select(
        "classes",
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
    )


def scan_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
) -> DataFrame:
    """One row per row of ``docs``: its words, those in windows of items, and the items.

    Columns ``_llm_row, doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.
    An item of fewer than ``window`` words is one window, one without words none. Null
    and empty texts have no words and no hits; the list of no items is the empty string.
    An item without an id has windows but is in no list; rows with the same id are one
    item. Repeated documents and null ids keep their rows. Other columns of both tables
    are not read, so their names may clash. Either table may be empty.
    """
    texts = written(
        row_key(docs)
        .select(
            ROW,
            F.col(doc_id).cast("long").alias("doc_id"),
            words_of(text_or_empty(text)).alias("words"),
        )
        .select(
            ROW, "doc_id", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words")
        ),
        "words",
    )
    windows = item_windows(items, item_text, item_id, window)
    lengths = windows.select(F.least("length", F.lit(WORDS)).alias("w")).distinct()
    widths = sorted(r["w"] for r in lengths.collect())  # WORDS different ones at most
    facts = texts.select(ROW, "doc_id", F.col("n_words").cast("long").alias("n_words"))
    nothing = F.sha2(F.lit(""), 256)
    if not widths:
        return facts.select(
            "*",
            F.lit(0).cast("long").alias("n_hit"),
            F.lit(0).cast("long").alias("n_items"),
            nothing.alias("items_sha256"),
            F.lit(False).alias("contaminated"),
        )
    known = window_shingles(windows, widths)
    met = met_shingles(texts, known, widths)
    hits = confirmed(candidates(met, rarest(known, met)), texts)
    lists = written(item_lists(hits, windows), "item-lists")
    named = hits.join(lists, "classes").select(ROW, "n_hit", "n_items", "items_sha256")
    return facts.join(named, ROW, "left").select(
        ROW,
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", nothing).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return scan_contamination(documents(spark, sf_dir), items).drop(ROW)


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
i AS (
  SELECT item_id, least(10, len(words)) AS n, words,
         unnest(range(1, len(words) - least(10, len(words)) + 2)) AS s
  FROM b WHERE len(words) > 0),
w AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(words, s, s + n - 1), ' ') AS win FROM i),
p AS (
  SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s
  FROM d, (SELECT DISTINCT n FROM w) WHERE len(words) >= n),
h AS (
  SELECT p.doc_id, p.s, w.n, w.item_id
  FROM (SELECT doc_id, s, n, array_to_string(list_slice(words, s, s + n - 1), ' ') AS win FROM p) p
  JOIN w ON w.n = p.n AND w.win = p.win),
places AS (SELECT doc_id, unnest(range(s, s + n)) AS place FROM (SELECT DISTINCT doc_id, s, n FROM h)),
n_hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM places GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items,
         sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(words), 0)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
