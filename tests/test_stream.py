"""The streaming job on files: restarts, replays, bad rows, empty input."""

import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from feedpulse.operators.metrics import headline_metrics, rollup_posts
from feedpulse.operators.scoring import LexiconScorer, ModelScorer, score_posts
from feedpulse.operators.view import posts_view
from feedpulse.schema import WIRE_SCHEMA
from feedpulse.sources.feed import read_posts_stream
from feedpulse.sources.messages import parse_posts, split_valid
from feedpulse.sources.table import latest_posts, next_version, read_versions
from feedpulse.streaming import jobs
from feedpulse.streaming.jobs import (
    StreamReporter,
    await_stream,
    batch_writer,
    read_folder,
    refresh_rollups,
    run_feed,
    run_stream,
)
from feedpulse.streaming.rollup import read_rollup

NOW = {"availableNow": True}


def post(id, title, created_at=1716500000, **other):
    fields = {"id": id, "created_at": created_at, "subreddit": "s", "title": title, "text": None}
    return json.dumps({**fields, "type": "submission", **other})


@pytest.fixture
def job(spark, tmp_path):
    class Job:
        source = tmp_path / "in"
        path = str(tmp_path / "out")
        checkpoint = str(tmp_path / "checkpoint")

        def land(self, name, *lines):
            self.source.mkdir(exist_ok=True)
            (self.source / name).write_text("\n".join(lines) + "\n")
            time.sleep(0.05)

        def run(self, **options):
            stream = read_posts_stream(spark, "text", max_per_batch=1, path=str(self.source))
            await_stream(
                run_stream(stream, self.path, self.checkpoint, trigger=NOW, **options), 120
            )

        def titles(self):
            rows = latest_posts(read_versions(spark, f"{self.path}/posts")).collect()
            return {r.id: (r.title, r.sentiment_label) for r in rows}

        def log(self):
            rows = read_folder(spark, f"{self.path}/batch_log").orderBy("batch_id").collect()
            return [(r.rows_in, r.rows_valid, r.rows_dead, r.rows_written) for r in rows]

    return Job()


def test_restart_continues_and_later_version_wins(spark, job):
    job.land("1.txt", post("a", "bad"), post("b", "fine"), post("a", "worse", 1716500009))
    job.run()
    assert job.titles() == {"a": ("worse", "negative"), "b": ("fine", "positive")}
    job.land("2.txt", post("a", "great"), "oops", '{"title": "no id"}')
    job.run()
    assert job.titles() == {"a": ("great", "positive"), "b": ("fine", "positive")}
    assert job.log() == [(3, 3, 0, 2), (3, 1, 2, 1)]
    dead = read_folder(spark, f"{job.path}/dead_letters").collect()
    assert {(r.value, r.reason) for r in dead} == {
        ("oops", "malformed"),
        ('{"title": "no id"}', "no_key"),
    }
    job.run()  # nothing new
    assert len(job.log()) == 2


def test_default_trigger_keeps_running(spark, job):
    job.land("1.txt", post("a", "good"))
    stream = read_posts_stream(spark, "text", path=str(job.source))
    query = run_stream(stream, job.path, job.checkpoint)
    try:
        query.processAllAvailable()
        assert query.isActive and job.titles() == {"a": ("good", "positive")}
        job.land("2.txt", post("a", "bad"))
        query.processAllAvailable()
        assert job.titles() == {"a": ("bad", "negative")}
        await_stream(query, 0.1)
        assert not query.isActive
    finally:
        query.stop()


def test_batch_of_bad_rows_only(spark, job):
    job.land("1.txt", "oops", "[]")
    job.run()
    job.land("2.txt", post("a", "good"))
    job.run()
    assert job.log() == [(2, 0, 2, 0), (1, 1, 0, 1)]
    assert job.titles() == {"a": ("good", "positive")}


def test_replayed_and_empty_batches(spark, job, tmp_path):
    df = spark.createDataFrame([(post("a", "good"),), ("oops",)], "value string")
    write = batch_writer(job.path)
    for _ in range(2):
        write(df, 5)
        write(df.where("false"), 6)
    assert job.log() == [(2, 1, 1, 1)]
    assert read_versions(spark, f"{job.path}/posts").count() == 1
    assert read_folder(spark, f"{job.path}/dead_letters").count() == 1


def test_crash_between_write_and_commit(spark, job, monkeypatch):
    """The posts were stored, the batch was not committed: nothing of it is seen.

    The restart replays it.
    """
    job.land("1.txt", post("a", "good"), post("b", "bad"))
    job.run()
    job.land("2.txt", post("a", "great"), "oops")
    write_folder = jobs._replace_folder

    def crash(df, path, batch_id):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(jobs, "_replace_folder", crash)
    with pytest.raises(StreamingQueryException):
        job.run()
    assert job.titles()["a"] == ("good", "positive")
    assert len(job.log()) == 1
    monkeypatch.setattr(jobs, "_replace_folder", write_folder)
    job.run()
    assert job.titles() == {"a": ("great", "positive"), "b": ("bad", "negative")}
    assert job.log() == [(2, 2, 0, 2), (2, 1, 1, 1)]
    assert read_versions(spark, f"{job.path}/posts").count() == 3


def test_feed_job_writes_messages_for_the_scoring_job(spark, job, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "1.json").write_text(
        "\n".join([post("a", " this is good "), post("b", "das ist nicht gut"), post("c", " ")])
    )
    stream = read_posts_stream(spark, "json", WIRE_SCHEMA, path=str(raw))
    await_stream(
        run_feed(stream, str(tmp_path / "feed"), "text", NOW, path=str(job.source)), 120
    )
    job.run()
    assert job.titles() == {"a": ("this is good", "positive")}


def test_lost_checkpoint(spark, job, tmp_path):
    job.land("1.txt", post("a", "good"), post("b", "fine"))
    job.run()
    job.land("2.txt", post("a", "great"))
    job.run()
    stored = f"{job.path}/posts"
    assert next_version(spark, stored) == 2
    job.checkpoint = str(tmp_path / "new-checkpoint")
    (job.source / "1.txt").unlink()  # the source keeps no more than the last file
    job.land("3.txt", post("a", "awful"))
    with pytest.raises(StreamingQueryException, match="set first_batch"):
        job.run()
    assert job.titles() == {"a": ("great", "positive"), "b": ("fine", "positive")}
    job.run(first_batch=next_version(spark, stored))
    assert job.titles() == {"a": ("awful", "negative"), "b": ("fine", "positive")}
    assert next_version(spark, str(tmp_path / "nothing")) == 0


def test_stream_equals_batch(spark, job):
    words = ["bad", "good", "fine"]
    lines = [post(str(i), f"{words[i % 3]} {i} " + "x " * (i * 40)) for i in range(40)]
    for part in range(4):
        job.land(f"{part}.txt", *lines[part::4])
    job.run()
    batch = spark.createDataFrame([(line,) for line in lines], "value string")
    valid, _ = split_valid(parse_posts(batch))
    columns = ["id", "title", "sentiment_label", "sentiment_score", "cleaned_text"]
    want = score_posts(valid).select(*columns).orderBy("id").collect()
    got = latest_posts(read_versions(spark, f"{job.path}/posts")).select(*columns)
    assert got.orderBy("id").collect() == want


def test_cleaning_inside_the_stream(spark, job):
    job.land(
        "1.txt",
        post("a", " this is good "),
        post("b", "das ist nicht gut"),
        post("c", " "),
        post("d", "this is it", subreddit="other"),
    )
    job.run(clean=True, communities=["s"], scorer_partitions=2)
    assert job.titles() == {"a": ("this is good", "positive")}
    assert job.log() == [(4, 4, 0, 1)]


def test_model_errors_do_not_stop_the_stream(spark, job):
    def load():
        def model(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("boom")
            return [("positive", 0.75) for _ in texts]

        return model

    job.land("1.txt", post("a", "one"), post("b", "boom"), post("c", "two"))
    job.run(scorer=ModelScorer(load))
    rows = latest_posts(read_versions(spark, f"{job.path}/posts")).orderBy("id").collect()
    assert [(r.sentiment_label, r.score_error) for r in rows] == [
        ("positive", False),
        ("neutral", True),
        ("positive", False),
    ]


def test_scorer_is_checked_before_the_start(spark, job):
    job.land("1.txt", post("a", "one"))
    with pytest.raises(ValueError):
        job.run(scorer=ModelScorer(lambda: lambda texts: 1 / 0))


def test_rollups_follow_the_stream(spark, tmp_path):
    source, parts = str(tmp_path / "scored"), str(tmp_path / "parts")
    rows = spark.range(200).select(
        F.col("id").cast("string"),
        F.timestamp_seconds(F.col("id") * 60).alias("created_at"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("subreddit"),
        F.lit("t").alias("title"),
        F.lit("x").alias("text"),
        F.lit("submission").alias("type"),
        F.when(F.col("id") % 2 == 0, "positive").otherwise("negative").alias("sentiment_label"),
        (F.col("id") / 200).alias("sentiment_score"),
    )
    rows.where("cast(id as int) < 90").write.parquet(source)

    def refresh():
        stream = read_posts_stream(spark, "parquet", rows.schema, path=source)
        await_stream(refresh_rollups(stream, parts, str(tmp_path / "cp"), NOW), 120)
        return read_rollup(spark, parts)

    assert refresh().agg(F.sum("posts")).first()[0] == 90
    rows.where("cast(id as int) >= 90").write.mode("append").parquet(source)
    rollup = refresh()
    want = rollup_posts(posts_view(rows))
    order = ["bucket", "subreddit", "sentiment_label"]
    rounded = [*order, "posts", "scored", F.round("score_sum", 9), "first_post", "last_post"]
    assert (
        rollup.orderBy(*order).select(*rounded).collect()
        == want.orderBy(*order).select(*rounded).collect()
    )
    assert headline_metrics(rollup).first().total_posts == 200


def test_no_folder_for_no_dead_letters(spark, job, tmp_path):
    job.land("1.txt", post("a", "good"))
    job.run()
    assert not (tmp_path / "out" / "dead_letters").exists()


def test_reporter_stores_progress(spark, job, tmp_path):
    reporter = StreamReporter(spark, str(tmp_path / "progress"))
    spark.streams.addListener(reporter)
    try:
        job.land("1.txt", post("a", "good"))
        job.run()
        assert reporter.wait_for("terminated")
    finally:
        spark.streams.removeListener(reporter)
    reports = read_folder(spark, reporter.path).orderBy("at").collect()
    events = [r["event"] for r in reports]
    assert events[0] == "started" and "progress" in events and "terminated" in events
    assert {r["batch_id"] for r in reports if r["event"] == "progress" and r["rows"]} == {0}


def test_json_file_stream(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "1.json").write_text(post("a", "good") + "\n")
    stream = read_posts_stream(spark, "json", WIRE_SCHEMA, path=str(tmp_path / "j"))
    query = score_posts(stream, LexiconScorer()).writeStream.format("memory").queryName("scored")
    await_stream(query.trigger(**NOW).start(), 60)
    assert spark.table("scored").first().sentiment_label == "positive"


def test_files_that_came_before_are_not_read(spark, job, tmp_path):
    """Not at the first start, and what comes while the stream is down is read at the next."""

    def run(**options):
        stream = read_posts_stream(spark, "text", path=str(job.source), **options)
        await_stream(run_stream(stream, job.path, job.checkpoint, trigger=NOW), 120)

    latest = {"starting": "latest", "marker": str(tmp_path / "start")}
    job.land("1.txt", post("a", "good"))
    run(**latest)
    assert not (tmp_path / "out").exists()
    job.land("2.txt", post("b", "bad"))
    run(**latest)
    job.land("3.txt", post("c", "bad"))
    run(**latest)
    assert set(job.titles()) == {"b", "c"}
    with pytest.raises(ValueError, match="marker"):
        run(starting="latest")
    job.path, job.checkpoint = str(tmp_path / "since"), str(tmp_path / "cp")
    run(starting="2001-01-01T00:00:00+00:00", marker=str(tmp_path / "other"))
    assert set(job.titles()) == {"a", "b", "c"}
