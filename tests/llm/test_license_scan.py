import re

import brute
import pytest
from pyspark.sql import functions as F

from feedpulse.llm.common import row_key
from feedpulse.llm.license_scan import (
    BLOCK,
    CONTAINED,
    PHRASES,
    TEMPLATES,
    blocks_of,
    join_templates,
    op1_license_scan,
    scan_licenses,
    template_words,
    word_order,
    words_of,
)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.ascii_lower(text or ""))


def base(text):
    own, at, labels = words(text), [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        places = [i for i in range(len(own)) if own[i : i + len(parts)] == parts]
        at += places
        if places:
            labels.add(label)
    return len(own), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def contained(text):
    """All matches by comparing every block with every template."""
    found = {}
    for paragraph in re.split(r"\n[\x20\t\r]*\n", text or ""):
        every = words(paragraph)
        for start in range(0, max(1, len(every) - BLOCK // 2), BLOCK // 2):
            own = set(every[start : start + BLOCK])
            for no, (_, template) in enumerate(TEMPLATES):
                need = template_words(template)
                share = len(own & set(need)) / len(need)
                if share >= CONTAINED:
                    found[no] = max(found.get(no, 0), share)
    return found


MIT = TEMPLATES[7][1]
CASES = [
    None,
    "",
    "MIT License",
    "the mit  license, mit-license; Apache\nLicense. mitlicense xmit license",
    "Licensed under CC BY-NC 4.0.",
    MIT.replace(" is ", "\nis ").upper(),
    MIT.replace("hereby", "now") + " and more " * 50,
    MIT[: len(MIT) // 2] + "\n\n" + MIT[len(MIT) // 2 :],
    "gnu general public license gnu general public license",
    "gnu lesser general public license",
    "ＭＩＴ license mit licenſe mit license",
    "a " * 60_000 + "apache license",
    TEMPLATES[8][1],
    "Redistribution and use, permitted",
]


@pytest.fixture
def docs(make):
    return make([(n, t) for n, t in enumerate(CASES)] + [(None, CASES[4])] * 2)


def test_cases(docs):
    out = scan_licenses(docs).collect()
    assert len(out) == len(CASES) + 2
    for r in out:
        text = CASES[4] if r.doc_id is None else CASES[r.doc_id]
        want = base(text)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        found = contained(text)
        labels = {TEMPLATES[no][0] for no in found} | set(filter(None, want[4].split(",")))
        assert r.labels == ",".join(sorted(labels))
        assert r.score == (1.0 if want[1] else max(found.values(), default=0.0))


def test_join_finds_every_pair(docs):
    own = row_key(docs)
    vocabulary = sorted({w for _, t in TEMPLATES for w in template_words(t)})
    paragraphs = F.transform(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\n[\x20\t\r]*\n"), words_of)
    held = own.select("_llm_row", F.posexplode(blocks_of(paragraphs, vocabulary, 5)))
    blocks = held.toDF("_llm_row", "block", "held")
    order = word_order(blocks, vocabulary)
    got = {
        (r["_llm_row"], r.template): r.c
        for r in join_templates(blocks, order)
        .groupBy("_llm_row", "template")
        .agg({"containment": "max"})
        .withColumnRenamed("max(containment)", "c")
        .collect()
    }
    want = {
        (r["_llm_row"], no): share for r in own.collect() for no, share in contained(r.text).items()
    }
    assert got == want and len(want) >= 6


def test_words_strewn_over_a_long_paragraph(make):
    """They are no notice; a notice amid a long paragraph is one, wherever it stands."""
    strewn = (" x" * 300).join("licensed under the apache licenses version 2.0 license".split())
    notice = "licensed under cc by sa 4.0"
    rows = [(k, "y " * k + notice + " z" * (400 - k)) for k in range(0, 400, 9)] + [(999, strewn)]
    for r in scan_licenses(make(rows)).collect():
        assert r.score == 0.0 if r.doc_id == 999 else "cc-by-sa" in r.labels, r.doc_id


def test_only_ascii_letters_are_folded(make):
    rows = [(1, "LICENSED UNDER THE APACHE LICENSE VERSION 2.0"), (2, "lİcensed under cc bY sa")]
    assert [r.labels for r in scan_licenses(make(rows)).orderBy("doc_id").collect()] == ["apache", "cc-by"]


def test_query(spark, small, texts):
    for r in op1_license_scan(spark, small).collect():
        want = base(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        found = contained(texts[r.doc_id])
        labels = {TEMPLATES[no][0] for no in found} | set(filter(None, want[4].split(",")))
        assert r.labels == ",".join(sorted(labels))
        assert r.score == (1.0 if want[1] else max(found.values(), default=0.0))


def test_empty_table(make):
    assert scan_licenses(make([])).count() == 0
