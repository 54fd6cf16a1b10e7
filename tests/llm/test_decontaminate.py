"""Windows of benchmark items in documents, against a plain scan of both."""

import hashlib
import re

import pytest
from brute import ascii_lower
from compare import assert_same, connect
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedpulse.llm.decontaminate import OP12_SQL, op12_decontaminate, scan_contamination

ITEMS = "item_id long, text string, words string, n_words int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def plain(docs, items, window=10):
    windows = {}
    for item, text in items:
        own = words(text)
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if own else 0):
            windows.setdefault(tuple(own[k : k + n]), set()).add(item)
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for w, ids in windows.items():
            for k in range(len(own) - len(w) + 1):
                if tuple(own[k : k + len(w)]) == w:
                    hit.update(range(k, k + len(w)))
                    found |= ids
        names = ",".join(sorted(str(i) for i in found if i is not None))
        out.append(
            (
                doc,
                len(own),
                len(hit),
                len([i for i in found if i is not None]),
                hashlib.sha256(names.encode()).hexdigest(),
                bool(hit),
            )
        )
    return sorted(out, key=repr)


def scanned(docs, items, **options):
    rows = scan_contamination(docs, items, **options).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )
    return sorted((tuple(r) for r in rows.collect()), key=repr)


LONG = " ".join(f"w{k}" for k in range(30))

DOC_ROWS = [
    (1, "before " + LONG + " after"),
    (2, LONG.upper().replace(" ", ", ")),
    (3, " ".join(f"w{k}" for k in range(9))),
    (4, None),
    (5, ""),
    (6, "-- ... !"),
    (7, "the Straße of Ünïcode"),
    (7, "the Straße of Ünïcode"),
    (None, "one two and then one two"),
    (8, " ".join(["again"] * 40)),
    (9, "filler " * 30_000 + LONG + " filler" * 30_000),
    (10, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"),
    (11, "the STRASSE of ünïcode the Straße of ünïcode"),
]
ITEM_ROWS = [
    (1, LONG),
    (1, "one two"),
    (10, "One, two!"),
    (2, "the straße of Ünïcode"),
    (3, "again " * 12),
    (4, None),
    (5, ""),
    (6, "?"),
    (None, "and then"),
    (20, LONG),
]


def test_edges(make):
    docs, items = make(DOC_ROWS), make(ITEM_ROWS, ITEMS, "items")
    assert scanned(docs, items) == plain(DOC_ROWS, ITEM_ROWS)


def test_clashing_columns(make):
    """Columns named like those the operator makes do not get in its way."""
    docs = make(
        [(1, LONG)], "doc_id long, text string, words int, n_words int, _llm_row int, window int"
    )
    items = make([(1, LONG)], "item_id long, text string, window int, shingle int", "items")
    assert scanned(docs, items) == plain([(1, LONG)], [(1, LONG)])


@pytest.mark.parametrize("empty", ["docs", "items"])
def test_empty_tables(make, empty):
    docs = make([] if empty == "docs" else DOC_ROWS[:6])
    items = make([] if empty == "items" else ITEM_ROWS, ITEMS, "items")
    expected = plain([] if empty == "docs" else DOC_ROWS[:6], [] if empty == "items" else ITEM_ROWS)
    assert scanned(docs, items) == expected


def test_shared_passage_makes_one_list(make):
    """A passage that all documents share with all items."""
    docs = [(k, f"own{k} " + LONG) for k in range(40)]
    items = [(k, LONG + f" q{k} r s t") for k in range(40)]
    assert scanned(make(docs), make(items, ITEMS, "items")) == plain(docs, items)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    docs=st.lists(st.lists(st.sampled_from("ab"), max_size=25), max_size=4),
    items=st.lists(st.lists(st.sampled_from("abc"), max_size=12), max_size=4),
)
def test_few_words(spark, docs, items):
    """Few different words: windows overlap, repeat, and have equal shingles at many places."""
    doc_rows = [(k, " ".join(w)) for k, w in enumerate(docs)]
    item_rows = [(k, " ".join(w)) for k, w in enumerate(items)]
    got = scanned(
        spark.createDataFrame(doc_rows, "doc_id long, text string"),
        spark.createDataFrame(item_rows, "item_id long, text string"),
        window=7,
    )
    assert got == plain(doc_rows, item_rows, 7)


def test_whole_table(spark, small, texts):
    import pyarrow.parquet as pq

    items = [
        (r["item_id"], r["text"])
        for r in pq.read_table(f"{small}/benchmark.parquet").to_pylist()
    ]
    got = sorted((tuple(r) for r in op12_decontaminate(spark, small).collect()), key=repr)
    assert got == plain(texts.items(), items)
    assert sum(r[-1] for r in got) >= 3
    assert_same(op12_decontaminate(spark, small).toArrow(), connect(small).sql(OP12_SQL).to_arrow_table())


def test_no_python_in_the_plan(spark, small):
    plan = op12_decontaminate(spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
