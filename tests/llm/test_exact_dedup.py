import hashlib
import re

from feedpulse.llm.common import ROW
from feedpulse.llm.exact_dedup import DigestIndex, dedup_exact, keep_first_copies

ROWS = [
    (5, "a b"),
    (3, "ab"),
    (4, "a\t b"),
    (1, None),
    (2, ""),
    (None, " \n"),
    (7, "x" * 50_000),
    (8, "x" * 25_000 + "\n" + "x" * 25_000),
    (9, "lone"),
    (9, "lone"),
]


def index(spark, tmp_path, name="index"):
    return DigestIndex(spark, f"file://{tmp_path}/{name}", 4)


def test_groups(spark, make, tmp_path):
    rows = dedup_exact(make(ROWS), index(spark, tmp_path)).collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    # "a\t b" is the longest of its group, " \n" of the empty ones, and bears no id.
    assert {r.doc_id for r in rows if r.keep_id == 4} == {3, 4, 5}
    assert [r.kept for r in by[4]] == [True]
    assert by[1][0].keep_id is None and not by[1][0].kept and by[None][0].kept
    assert by[1][0].group_size == 3
    assert by[8][0].kept and not by[7][0].kept
    # Rows that are the same in all columns: exactly one stays.
    assert sorted(r.kept for r in by[9]) == [False, True]
    assert by[5][0].text_sha256 == hashlib.sha256(b"ab").hexdigest()
    assert all(re.fullmatch("[0-9a-f]{64}", r.text_sha256) for r in rows)


def test_new_rows_meet_the_index(spark, make, tmp_path):
    own = index(spark, tmp_path)
    dedup_exact(make([(1, "a"), (2, "b")]), own).collect()
    own.close()
    again = DigestIndex(spark, f"file://{tmp_path}/index", 4)
    found = {r.doc_id: r for r in dedup_exact(make([(3, "b b"), (4, "b"), (5, "c")], name="new"), again).collect()}
    assert found[4].known and found[4].keep_id == 2 and not found[4].kept
    assert found[5].kept and not found[5].known
    assert again.rows().count() == 4


def test_index_is_read_without_shuffle(spark, make, tmp_path):
    own = index(spark, tmp_path)
    rows = make([(1, "a")])
    dedup_exact(rows, own).collect()
    new = spark.range(3).selectExpr("cast(id as string) AS digest")
    plan = new.join(own.rows().select("digest").hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    scan = text[text.index("FileScan") :]
    assert "Exchange" not in scan and "SelectedBucketsCount: 4 out of 4" in text


def test_empty_table(spark, make, tmp_path):
    assert dedup_exact(make([]), index(spark, tmp_path)).count() == 0


def test_stage_keeps_columns_and_one_row_of_each_text(spark, make):
    docs = make(ROWS)
    kept = keep_first_copies(spark, docs, "")
    assert kept.columns == docs.columns and ROW not in kept.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "8", "9", "None"]


def test_the_same_batch_again_gives_the_same_rows(spark, make, tmp_path):
    """A failure after the digests were stored: the batch is run once more."""
    own = index(spark, tmp_path)
    dedup_exact(make([(1, "a"), (2, "b")]), own, batch="one").collect()
    docs = make([(3, "b "), (4, "b"), (5, "c"), (6, "c "), (6, "c ")], name="new")
    want = sorted(tuple(r)[1:] for r in dedup_exact(docs, own, batch="two").collect())
    for parts in (1, 5):
        got = dedup_exact(docs.repartition(parts), own, batch="two").collect()
        assert sorted(tuple(r)[1:] for r in got) == want
    assert sum(r[3] for r in want) == 1 and own.rows().count() == 3
    # A later batch finds both known.
    assert not any(r.kept for r in dedup_exact(docs, own, batch="three").collect())


def test_a_hot_text_is_split(spark, make, tmp_path):
    """The join of rows with their groups is one that Spark can cut where a digest is hot."""
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        docs = make([(k, "hot" if k % 3 else f"own {k}") for k in range(4000)])
        found = dedup_exact(docs, index(spark, tmp_path))
        assert found.where("kept").count() == 1 + 1334
        found = found.select("doc_id", "kept", "text_sha256")
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_stage_under_another_split_of_its_input(spark, make, tmp_path):
    """Scans of the same files that are split otherwise keep the same documents."""
    path = str(tmp_path / "many")
    rows = [(k, f"text {k % 40}") for k in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(24).write.parquet(path)
    kept = []
    conf = "spark.sql.files.openCostInBytes"
    try:
        for cost in ("1", "64m"):
            spark.conf.set(conf, cost)
            docs = keep_first_copies(spark, spark.read.parquet(path), "")
            spark.conf.set(conf, "64m")  # while it runs
            kept.append(sorted(r.doc_id for r in docs.collect()))
    finally:
        spark.conf.unset(conf)
    assert kept == [list(range(40))] * 2


def test_stage_with_columns_named_like_its_own(spark):
    docs = spark.createDataFrame([(1, "a", 5), (2, "a", 6)], "doc_id long, text string, _llm_row int")
    assert [tuple(r) for r in keep_first_copies(spark, docs, "").collect()] == [(1, "a", 5)]
