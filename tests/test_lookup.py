"""Lookups by the index of files against scans of the whole table."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedpulse.plans.catalog import indexed_lookup
from feedpulse.sources.commits import CommitLog, hour_of
from feedpulse.sources.lookup import files_with, index_files, lookup_posts, newest_posts, posts_of
from feedpulse.sources.table import scan_posts, upsert_posts
from feedpulse.sources.tiers import compact_windows

DAY = datetime(2024, 5, 24)


@pytest.fixture
def feed(spark, tmp_path):
    class Feed:
        path = f"file://{tmp_path}/feed"
        log = CommitLog(spark, path)

        def write(self, number, rows):
            """``rows`` of (id, epoch seconds or None, community)."""
            posts = spark.createDataFrame(rows, "id string, s long, subreddit string").select(
                "id",
                F.timestamp_seconds("s").alias("created_at"),
                "subreddit",
                F.concat(F.lit(f"v{number} "), "id").alias("title"),
                F.lit("").alias("text"),
                F.lit("submission").alias("type"),
                F.lit("neutral").alias("sentiment_label"),
                F.lit(0.5).alias("sentiment_score"),
                F.lit("").alias("cleaned_text"),
                F.lit(False).alias("score_error"),
            )
            upsert_posts(posts.coalesce(1), number, f"{self.path}/posts", DAY)
            self.log.commit({f"posts/batch_id={number}": hour_of(DAY)}, batch=number)

        def batches(self, n=8, size=50):
            for b in range(n):
                self.write(b, [(f"p{b * size + k:05d}", 1000 * b + k, f"s{b % 4}") for k in range(size)])

        def titles(self, df):
            return sorted((r.id, r.title) for r in df.collect())

        def table(self):
            return scan_posts(spark, f"{self.path}/posts")

    return Feed()


def test_lookup_opens_only_the_files_it_needs(spark, feed):
    feed.batches()
    assert index_files(spark, feed.path) == 8 and index_files(spark, feed.path) == 0
    ids = ["p00003", "p00390", "absent", "p00391"]
    found = lookup_posts(spark, feed.path, ids)
    assert feed.titles(found) == [("p00003", "v0 p00003"), ("p00390", "v7 p00390"), ("p00391", "v7 p00391")]
    assert len(found.inputFiles()) == 2
    assert lookup_posts(spark, feed.path, ["absent"]).count() == 0
    assert lookup_posts(spark, feed.path, [None]).count() == 0
    assert lookup_posts(spark, feed.path, []).count() == 0
    table = spark.createDataFrame([(1, "p00003"), (2, None)], "n int, id string")
    assert feed.titles(lookup_posts(spark, feed.path, table)) == [("p00003", "v0 p00003")]


def test_newer_versions_and_folders_without_an_index(spark, feed):
    feed.batches()
    index_files(spark, feed.path)
    before = feed.log.snapshot().number
    feed.write(8, [("p00003", 5, "s9"), ("new", 6, "s9")])
    assert feed.titles(lookup_posts(spark, feed.path, ["p00003", "new"])) == [
        ("new", "v8 new"),
        ("p00003", "v8 p00003"),
    ]
    assert feed.titles(lookup_posts(spark, feed.path, ["p00003"], before)) == [("p00003", "v0 p00003")]
    assert index_files(spark, feed.path) == 1
    assert len(lookup_posts(spark, feed.path, ["new"]).inputFiles()) == 1
    # Those that were in a community and are not any more are left out.
    mine = {r.id for r in feed.table().where("subreddit = 's0'").collect()}
    assert {r.id for r in posts_of(spark, feed.path, ["s0"]).collect()} == mine
    assert "p00003" not in mine and len(mine) == 99


def test_lookup_after_a_compaction(spark, feed):
    feed.batches(4)
    index_files(spark, feed.path)
    compact_windows(spark, feed.path, DAY + timedelta(hours=2))
    want = [("p00003", "v0 p00003")]
    assert feed.titles(lookup_posts(spark, feed.path, ["p00003"])) == want
    assert index_files(spark, feed.path) == 1
    assert feed.titles(lookup_posts(spark, feed.path, ["p00003"])) == want


def test_all_that_is_stored_is_found(spark, feed):
    """No false negatives, and few false positives."""
    feed.batches(6, 200)
    index_files(spark, feed.path)
    ids = feed.table().select("id")
    assert lookup_posts(spark, feed.path, ids).count() == 1200
    absent = spark.range(300).select(F.concat(F.lit("p0010"), "id").alias("value"))
    one_file = [files_with(spark, feed.path, absent.where(F.col("value") == f"p0010{k}")) for k in range(10, 14)]
    assert sum(map(len, one_file)) <= 2


def test_many_numbers_open_the_files_they_are_in(spark, feed):
    """Files on both sides of 1,000 span all numbers by text; the filter alone lets some pass."""
    for b in range(3):
        feed.write(b, [(str(b * 800 + k), k, "s") for k in range(800)])
    index_files(spark, feed.path)
    asked = spark.range(800).select(F.col("id").cast("string").alias("id"))
    found = lookup_posts(spark, feed.path, asked)
    assert found.count() == 800 and len(found.inputFiles()) == 1
    [old] = feed.log.snapshot().of("lookup")
    facts = spark.read.parquet(f"{feed.path}/{old}").drop("first_id", "last_id")
    facts.write.parquet(f"{feed.path}/lookup/part=before")
    feed.log.commit({"lookup/part=before": hour_of(DAY)}, [old])
    assert lookup_posts(spark, feed.path, asked).count() == 800


@pytest.mark.parametrize("asked, skipped", [(200, True), (1000, False)])
def test_only_files_of_the_feed_count_as_opened(spark, tmp_path, asked, skipped):
    """Documents that come in more files than the feed has; with all numbers none is left out."""
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(f"{tmp_path}/events.parquet")
    documents = spark.range(asked).withColumnRenamed("id", "doc_id").repartition(12)
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    rows = indexed_lookup(spark, str(tmp_path)).collect()
    assert len(rows) == asked and {r.files_skipped for r in rows} == {skipped}


def test_newest_posts_stop_early(spark, feed):
    feed.batches(16)
    index_files(spark, feed.path)
    want = [r.id for r in scan_posts(spark, f"{feed.path}/posts", limit=10).collect()]
    opened = []
    got = newest_posts(spark, feed.path, 10, opened)
    assert [r.id for r in got.orderBy(F.desc("created_at"), "id").collect()] == want
    assert len(opened) == 2


def test_newest_posts_that_were_sent_again(spark, feed):
    """The newest posts get older times, others newer ones, ties and posts without a time."""
    feed.batches(6)
    feed.write(6, [(f"p{250 + k:05d}", 10, "s0") for k in range(30, 50)] + [("undated", None, "s0")])
    feed.write(7, [(f"p{k:05d}", 5020, "s0") for k in range(7)])
    index_files(spark, feed.path)
    for k in (1, 5, 10, 40):
        want = scan_posts(spark, f"{feed.path}/posts", limit=k)
        assert feed.titles(newest_posts(spark, feed.path, k)) == feed.titles(want)
    everything = feed.titles(newest_posts(spark, feed.path, 1000))
    assert len(everything) == 301 and everything == feed.titles(feed.table())
