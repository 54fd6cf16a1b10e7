"""The stored table: versions, replays, retention, compaction, catalog."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedpulse.operators.scoring import score_posts
from feedpulse.schema import TABLE_SCHEMA, VIEW_COLUMNS
from feedpulse.sources import table as tb

DAY1 = datetime(2024, 3, 1, 10, 0)
DAY2 = datetime(2024, 3, 2, 9, 0)


def posts(spark, *rows):
    """Rows of (id, title, minute of creation)."""
    df = spark.createDataFrame(
        [(i, datetime(2024, 3, 1, 8, minute), "s", t, "", "submission") for i, t, minute in rows],
        "id string, created_at timestamp, subreddit string, title string, text string, type string",
    )
    return score_posts(df)


def titles(df):
    return {r.id: r.title for r in df.collect()}


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "posts")


def test_later_batch_wins_and_replay_changes_nothing(spark, path):
    first = posts(spark, ("a", "one", 1), ("b", "two", 2))
    second = posts(spark, ("a", "one again", 1), ("c", "three", 3))
    tb.upsert_posts(first, 0, path, DAY1)
    tb.upsert_posts(second, 1, path, DAY1)
    want = {"a": "one again", "b": "two", "c": "three"}
    assert titles(tb.latest_posts(tb.read_versions(spark, path))) == want
    tb.upsert_posts(second, 1, path, DAY2)  # replayed after midnight
    assert titles(tb.latest_posts(tb.read_versions(spark, path))) == want
    assert tb.read_versions(spark, path).count() == 4
    tb.upsert_posts(first, 0, path, DAY2)
    assert titles(tb.latest_posts(tb.read_versions(spark, path))) == want


def test_negative_batch_numbers_are_refused(spark, path):
    with pytest.raises(ValueError):
        tb.upsert_posts(posts(spark, ("a", "x", 1)), -1, path, DAY1)


def test_newest_in_batch(spark):
    rows = [("a", "x", 1), ("a", "y", 3), ("a", "z", 2), ("b", "q", 1)]
    df = posts(spark, *rows).select("id", "created_at", "subreddit", "title", "text", "type")
    assert titles(tb.newest_in_batch(df)) == {"a": "y", "b": "q"}
    offsets = df.withColumn("offset", F.when(F.col("title") == "z", 9).otherwise(1))
    assert titles(tb.newest_in_batch(offsets)) == {"a": "z", "b": "q"}


def test_latest_per_key(spark):
    rows = [("hot", f"{i:02}", i) for i in range(40)] + [(f"s{i}", "x", 1) for i in range(40)]
    rows += [(None, "no id", 2)] * 2
    df = posts(spark, *rows)
    got = tb.latest_per_key(df, "id", "created_at")
    assert got.columns == df.columns and got.count() == 43
    assert titles(got.where("id IS NOT NULL"))["hot"] == "39"


def test_reading_the_latest_runs_no_job_and_leaves_the_base(spark, path, tmp_path):
    tb.upsert_posts(posts(spark, *[(f"{i}", "x", 1) for i in range(50)]), 0, path, DAY1)
    target = str(tmp_path / "base")
    tb.compact(spark, path, target)
    tb.upsert_posts(posts(spark, ("3", "y", 1)), 1, target, DAY2)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("reading", "reading")
    view = tb.scan_posts(spark, target)
    jobs = tracker.getJobIdsForGroup("reading")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) == 0
    plan = view._jdf.queryExecution().executedPlan().toString()
    base = next(part for part in plan.split("Union")[1].split("+- *") if "LeftAnti" in part)
    assert "BroadcastHashJoin" in base
    assert titles(view)["3"] == "y" and view.count() == 50


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"),
        F.col("id").alias("v"),
        F.repeat(F.lit("x"), 20).alias("payload"),
    )
    got = {r.k: r.v for r in tb.latest_per_key(df, "k", "v").collect()}
    want = {r.k: r.v for r in df.groupBy("k").agg(F.max("v").alias("v")).collect()}
    assert got == want


def test_compaction_keeps_the_newest_and_later_batches_win(spark, path, tmp_path):
    target = str(tmp_path / "compacted")
    for batch in range(4):
        scored = posts(spark, ("a", f"v{batch}", 1), (f"n{batch}", "x", 2))
        tb.upsert_posts(scored, batch, path, DAY1)
    tb.compact(spark, path, target, files=2)
    stored = tb.read_versions(spark, target)
    assert stored.count() == 5
    assert titles(stored)["a"] == "v3"
    # The last batch may be replayed after a crash, then the stream goes on.
    tb.upsert_posts(posts(spark, ("a", "v3 again", 1)), 3, target, DAY1)
    assert titles(tb.latest_posts(tb.read_versions(spark, target)))["a"] == "v3 again"
    tb.upsert_posts(posts(spark, ("a", "v4", 1)), 4, target, DAY1)
    again = str(tmp_path / "again")
    tb.compact(spark, target, again)
    assert titles(tb.read_versions(spark, again)) == titles(
        tb.latest_posts(tb.read_versions(spark, target))
    )
    assert tb.read_versions(spark, again).count() == 5


def steps(df):
    """Sections of the plan, one an operator with what goes into it."""
    explain = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    return explain(df._jdf.queryExecution(), "formatted").split("\n\n")


def test_compaction_moves_texts_once(spark, path, monkeypatch):
    for batch in range(2):
        tb.upsert_posts(posts(spark, ("a", f"v{batch}", 1), ("b", "x", 2)), batch, path, DAY1)
    written = []
    monkeypatch.setattr(tb, "_write_folder", lambda df, *a, **o: written.append(df))
    tb.compact(spark, path, "unused")
    with_texts = [s for s in steps(written[0]) if "cleaned_text" in s]
    assert sum("Exchange" in s.split("\n")[0] for s in with_texts) == 1
    assert not any("Aggregate" in s.split("\n")[0] or "Join" in s.split("\n")[0] for s in with_texts)


def test_compacted_rows_alone_are_read_where_they_are(spark, path, tmp_path):
    tb.upsert_posts(posts(spark, ("a", "one", 1), ("b", "two", 2)), 0, path, DAY1)
    target = str(tmp_path / "target")
    tb.compact(spark, path, target)
    assert not [s for s in steps(tb.scan_posts(spark, target)) if "Exchange" in s or "Join" in s]
    assert titles(tb.scan_posts(spark, target)) == {"a": "one", "b": "two"}
    tb.upsert_posts(posts(spark, ("b", "again", 2)), 1, target, DAY1)
    assert titles(tb.scan_posts(spark, target)) == {"a": "one", "b": "again"}


def test_compaction_of_posts_that_move(spark, path, tmp_path):
    """Versions with other communities and times, none at all, and rows without an id."""
    for batch in range(3):
        df = spark.range(0, 300, batch + 1).select(
            F.when(F.col("id") % 50 != 7, F.col("id").cast("string")).alias("id"),
            F.when(F.col("id") % 5 != batch, F.timestamp_seconds(F.col("id") * 977 * (batch + 1))).alias("created_at"),
            F.when(F.col("id") % 7 != batch, F.concat(F.lit("s"), (F.col("id") + batch) % 3)).alias("subreddit"),
            F.lit(f"v{batch}").alias("title"),
            F.lit("").alias("text"),
            F.lit("submission").alias("type"),
        )
        tb.upsert_posts(score_posts(df), batch, path, DAY1)
    target = path
    for k in range(3):
        want = tb.latest_posts(tb.read_versions(spark, target)).drop("batch_id")
        source, target = target, str(tmp_path / f"target{k}")
        tb.compact(spark, source, target, files=4)
        got = tb.read_versions(spark, target).drop("batch_id")
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
        tb.upsert_posts(posts(spark, ("3", f"again {k}", 9), (f"new{k}", "x", 3)), k + 2, target, DAY1)


def test_compaction_keeps_all_days(spark, path, tmp_path):
    tb.upsert_posts(posts(spark, ("a", "one", 1)), 0, path, DAY1)
    tb.upsert_posts(posts(spark, ("b", "two", 1)), 1, path, DAY2)
    target = str(tmp_path / "both-days")
    for _ in range(2):
        tb.compact(spark, path, target)
    assert titles(tb.read_versions(spark, target)) == {"a": "one", "b": "two"}
    days = {r.dt for r in tb.read_versions(spark, target).select("dt").collect()}
    assert days == {date(2024, 3, 1), date(2024, 3, 2)}


def test_files_are_clustered(spark, path, tmp_path):
    rows = [(f"{i:03}", "t", i % 60) for i in range(200)]
    tb.upsert_posts(posts(spark, *rows), 0, path, DAY1)
    target = str(tmp_path / "clustered")
    tb.compact(spark, path, target, files=4)
    ranges = (
        tb.read_versions(spark, target)
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("created_at").alias("lo"), F.max("created_at").alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert len(ranges) > 1
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))


def test_scan(spark, path):
    tb.upsert_posts(posts(spark, ("a", "one", 1), ("b", "bad", 30)), 0, path, DAY1)
    tb.upsert_posts(posts(spark, ("a", "again", 1)), 1, path, DAY2)
    view = tb.scan_posts(spark, path)
    assert view.columns == VIEW_COLUMNS
    assert titles(view) == {"a": "again", "b": "bad"}
    assert tb.scan_posts(spark, path, limit=1).count() == 1
    since = tb.scan_posts(spark, path, since=datetime(2024, 3, 1, 8, 15))
    assert titles(since) == {"b": "bad"}
    assert tb.scan_posts(spark, path, since=datetime(2024, 3, 2)).count() == 0


def test_scan_since_is_a_plain_filter(spark, path):
    """Also for posts that were stored before the time they give as their creation."""
    tb.upsert_posts(posts(spark, ("a", "one", 1)), 0, path, datetime(2024, 2, 28))
    since = datetime(2024, 3, 1)
    plain = tb.scan_posts(spark, path).where(F.col("created_at") >= F.lit(since))
    scan = tb.scan_posts(spark, path, since=since)
    assert titles(scan) == titles(plain) == {"a": "one"}


def test_nothing_stored_yet(spark, path):
    assert tb.scan_posts(spark, path).columns == VIEW_COLUMNS
    assert tb.scan_posts(spark, path).count() == 0


def test_retention(spark, path):
    now = datetime(2024, 4, 1, 12, 0)
    for batch, day in enumerate(["2024-03-01", "2024-03-02", "2024-03-03", "2024-03-31"]):
        stamp = datetime.fromisoformat(f"{day}T18:00:00")
        tb.upsert_posts(posts(spark, (day, "x", 1)), batch, path, stamp)
    kept = tb.retain(tb.read_versions(spark, path), 30, now)
    assert sorted(r.id for r in kept.collect()) == ["2024-03-02", "2024-03-03", "2024-03-31"]
    dropped = tb.drop_expired(spark, path, 30, now)
    assert dropped == 1
    assert tb.read_versions(spark, path).count() == 3
    assert tb.drop_expired(spark, path, 30, now) == 0
    assert tb.scan_posts(spark, path, retention_days=30).count() == 0


def bloom_filtered_columns(spark, path):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(tb.read_versions(spark, path).inputFiles()[0])
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(file, conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    names = {c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() >= 0}
    reader.close()
    return names


def test_compacted_files_have_bloom_filters(spark, path, tmp_path):
    tb.upsert_posts(posts(spark, *[(str(i), "x", 1) for i in range(50)]), 0, path, DAY1)
    assert not bloom_filtered_columns(spark, path)
    tb.compact(spark, path, str(tmp_path / "compacted"))
    assert "id" in bloom_filtered_columns(spark, str(tmp_path / "compacted"))


def test_layout_columns(spark):
    df = tb.with_insertion_time(posts(spark, ("a", "x", 5)), DAY2)
    row = tb.with_layout_columns(df).first()
    assert (row.bucket, row.dt) == (8, date(2024, 3, 2))


def test_catalog_table(spark, path):
    """One row per id, as the read of the table gives."""
    tb.upsert_posts(posts(spark, ("a", "one", 1), ("b", "bad", 2)), 0, path, DAY1)
    try:
        for _ in range(2):
            tb.ensure_table(spark, "feed_db.posts", path)
        tb.upsert_posts(posts(spark, ("a", "again", 1)), 1, path, DAY2)
        tb.ensure_table(spark, "feed_db.posts", path)
        assert titles(spark.table("feed_db.posts")) == {"a": "again", "b": "bad"}
        assert spark.table("feed_db.posts").count() == 2
        assert spark.table("feed_db.posts_versions").count() == 3
        listed = {c.name for c in spark.catalog.listColumns("feed_db.posts")}
        assert listed == set(TABLE_SCHEMA.fieldNames())
    finally:
        spark.sql("DROP DATABASE IF EXISTS feed_db CASCADE")
