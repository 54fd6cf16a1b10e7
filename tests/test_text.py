"""Text expressions against plain Python renderings of the same rules."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedpulse.functions import text as tx

EDGE_TEXTS = [
    "@bob see http://x now",
    "a @ b",
    "https\n@z end",
    "a  b ",
    "",
    " ",
    "@",
    "@@ @a@b httpx xhttp HTTP",
    "   wide  \x85",
    "\x1c\x1d\x1e\x1f x \x0b\x0c",
    "@é httpé \U0001f600",
    "ok",
    "bad",
    " a b ",
    "a  ",
    "   ",
    "\U0001f600\U0001f600",
    "\U0001f600 \U0001f600",
    "$1 \\1 @$x",
    *["x" * n for n in (511, 512, 513, 1024, 1300, 1536, 1537, 5000)],
    "é\U0001f600" * 700,
]

# Letters that matter to the rules, and some that only look as if they did.
messy = st.text(alphabet="@ht p\n  \x1cé\U0001f600s/", max_size=60)


def py_normalize(text):
    if not text:
        return ""
    out = []
    for token in text.split(" "):
        if token.startswith("@") and len(token) > 1:
            token = "@user"
        out.append("http" if token.startswith("http") else token)
    return " ".join(out)


def py_chunks(text, size, most):
    chunks = [text[i : i + size] for i in range(0, len(text), size)]
    return chunks if most is None else chunks[:most]


def evaluate(spark, texts, **columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return df.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()


def check(spark, texts):
    t = F.col("t")
    rows = evaluate(
        spark,
        texts,
        normal=tx.normalize_mentions_links(t),
        stripped=tx.strip_ws(t),
        short=tx.is_too_short(t),
        visible=tx.has_text(t),
        chunks=tx.chunk_text(t, max_chunks=3),
        small=tx.chunk_text(t, 7, None),
        cleaned=tx.cut_text(t),
    )
    for text, row in zip(texts, rows):
        assert row.normal == py_normalize(text)
        assert row.stripped == text.strip()
        assert row.short == (len(text.strip()) < 3)
        assert row.visible == bool(text.strip())
        assert row.chunks == py_chunks(text, 512, 3)
        assert row.small == py_chunks(text, 7, None)
        assert row.cleaned == (text[:512] + "... [truncated]" if len(text) > 512 else text)


def test_edge_texts(spark):
    check(spark, EDGE_TEXTS)


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(texts=st.lists(messy, min_size=20, max_size=60))
def test_random_texts(spark, texts):
    check(spark, texts)


def test_every_whitespace_character(spark):
    texts = [chr(c) + "x" + chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    rows = evaluate(spark, texts, stripped=tx.strip_ws(F.col("t")))
    assert [r.stripped for r in rows] == [t.strip() for t in texts]


def test_long_runs_are_no_trouble(spark):
    """Runs this long would take a backtracking expression hours or its stack."""
    n = 300_000
    texts = [
        "a" + " " * n + "b" + " \n" * n,
        " " * n + "ab" + "\u00a0" * n,
        "\t" * n,
        "@" + "x" * n + " http" + "\n" * n,
        ". " * n,
    ]
    check(spark, texts)


def test_nulls(spark):
    null = F.lit(None).cast("string")
    row = evaluate(
        spark,
        ["x"],
        blank=tx.blank_if_null(null),
        normal=tx.normalize_mentions_links(null),
        short=tx.is_too_short(null),
        both=tx.combine_text(null, null),
        one=tx.combine_text(F.lit("a"), null),
        preview=tx.preview(null, 5),
    )[0]
    assert (row.blank, row.normal, row.short, row.both, row.one, row.preview) == (
        "",
        "",
        True,
        " ",
        "a ",
        "",
    )


@pytest.mark.parametrize("n", [80, 500])
def test_preview(spark, n):
    rows = evaluate(spark, ["é" * n, "é" * (n + 1)], p=tx.preview(F.col("t"), n))
    assert [r.p for r in rows] == ["é" * n, "é" * n + "..."]


def test_short_limit(spark):
    low = [tx.is_too_short(F.col("t"), n).alias(f"n{n}") for n in (0, 1, 2)]
    df = spark.createDataFrame([("",), (" ",), (" a",), ("ab ",), (None,)], "t string")
    assert [tuple(r) for r in df.select(*low).collect()] == [
        (False, True, True),
        (False, True, True),
        (False, False, True),
        (False, False, False),
        (True, True, True),
    ]
    rows = evaluate(spark, ["abcd", "abcde", " a  b "], s=tx.is_too_short(F.col("t"), 5))
    assert [r.s for r in rows] == [True, False, True]
