import corpus_pipeline
from feedpulse.llm import queries
from feedpulse.llm.common import documents
from feedpulse.llm.packing import default_tokenizer
from feedpulse.llm.word_ids import WordIds

import brute
import re
import zlib

import numpy as np

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def test_queries_are_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert sorted({int(q[2:].split("_")[0]) for q in queries.QUERIES}) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


def test_stages_by_brute_force(spark):
    docs, kept = documents(spark, SF), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns
        kept[name] = [r.asDict() for r in out.collect()]
        docs = corpus_pipeline.written(out, name)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {r["doc_id"] for r in kept["quality"]}
    assert np.mean([(d in good) == bool(q) for d, q in quality.items()]) >= 0.97

    best = {}
    for r in kept["quality"]:
        key = re.sub(r"[\x20\x09-\x0D]", "", r["text"])
        best[key] = min(best.get(key, (1, 0)), (-len(r["text"]), r["doc_id"]))
    assert {r["doc_id"] for r in kept["exact_dedup"]} == {d for _, d in best.values()}

    near = brute.near_duplicates([(r["doc_id"], r["text"]) for r in kept["exact_dedup"]])
    assert {r["doc_id"] for r in kept["near_dedup"]} == {d for d, (_, c) in near.items() if c == d}
    before = {r["doc_id"]: r for r in kept["near_dedup"]}
    assert len(kept["secret_scan"]) == len(before)
    masked = [r for r in kept["secret_scan"] if r["text"] != before[r["doc_id"]]["text"]]
    assert masked and all("[SECRET]" in r["text"] for r in masked)
    assert all(r["n_chars"] == len(r["text"]) for r in kept["secret_scan"])

    words = WordIds(default_tokenizer())
    packed = {}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect():
        packed.setdefault(r.doc_id, []).append(r)
    assert set(packed) == set(before)
    for r in kept["secret_scan"]:
        ids = np.array([*words.library.encode(r["text"], add_special_tokens=False).ids, 1], "<u4")
        first = min(packed[r["doc_id"]], key=lambda p: p.piece)
        assert sum(p.length for p in packed[r["doc_id"]]) == len(ids)
        assert first.ids_crc32 == zlib.crc32(ids[:4096].tobytes())


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and "sequence_id" in rows.columns
