"""The registered queries: each runs one group of operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedpulse.functions.text import (
    chunk_text,
    combine_text,
    cut_text,
    is_too_short,
    normalize_mentions_links,
    strip_ws,
)
from feedpulse.functions.times import UNITS, epoch_to_ts, floor_ts, time_text, ts_to_epoch
from feedpulse.functions.wordlists import NEGATIVE_WORDS, POSITIVE_WORDS
from feedpulse.operators.language import detect_language
from feedpulse.operators.learned import LearnedModel, learn
from feedpulse.operators.metrics import (
    adaptive_bucket,
    community_sentiment,
    headline_metrics,
    label_distribution,
    most_common_label,
    rollup_posts,
    sentiment_trend,
    table_summary,
    time_span,
    top_communities,
    trend_summary,
)
from feedpulse.operators.scoring import ModelScorer, score_posts
from feedpulse.operators.view import (
    post_cards,
    posts_view,
    raw_sample,
    recent_posts,
    schema_report,
)
from feedpulse.plans.posts import as_posts, load, load_documents, timed_posts, untimed_posts
from feedpulse.plans.panels import dashboard
from feedpulse.schema import VIEW_COLUMNS
from feedpulse.session import shared_folder
from feedpulse.sources.feed import clean_feed, posts_feed, posts_since, read_posts_stream
from feedpulse.sources.messages import (
    decode_kafka,
    parse_json,
    parse_posts,
    require_key,
    split_valid,
    to_messages,
)
from feedpulse.sources.commits import CommitLog, files, hour_of
from feedpulse.sources.lookup import index_files, lookup_posts, newest_posts
from feedpulse.sources.table import (
    compact,
    drop_expired,
    ensure_table,
    latest_per_key,
    latest_posts,
    read_versions,
    retain,
    scan_posts,
    upsert_posts,
    with_layout_columns,
)
from feedpulse.sources.tiers import compact_windows
from feedpulse.streaming.jobs import (
    StreamReporter,
    await_stream,
    batch_writer,
    read_folder,
    refresh_rollups,
    run_feed,
    run_stream,
)
from feedpulse.streaming.rollup import read_late, read_rollup, read_trend, run_rollup, run_trend

# The time all written batches of a query carry, so that results repeat.
AS_OF = datetime(2024, 2, 10)
#: Bytes of stored documents that become one file of messages.
TOPIC_FILE = 16 << 20
FEED = ["src0", "src1", "src2", "src3", "src5", "src8", "src13", "src17", "src19"]


def _score6(col: str = "sentiment_score") -> Column:
    return F.round(col, 6).alias(col)


def _ntz(col: str) -> Column:
    return F.col(col).cast("timestamp_ntz").alias(col)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_view(score_posts(untimed_posts(spark, sf_dir)))


def _events_view(spark: SparkSession, sf_dir: str, pace: int = 1) -> DataFrame:
    """All events as scored posts, their clock divided by ``pace``.

    A faster clock shortens the span of the whole table without leaving out rows,
    which is how each bucket size of the trend comes to be used.
    """
    micros = F.expr(f"unix_micros(CAST(ts AS TIMESTAMP)) div {pace}")
    return load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.timestamp_micros(micros).alias("created_at"),
        F.concat(F.lit("user"), F.col("user_id")).alias("subreddit"),
        F.lit("").alias("title"),
        F.lit("").alias("text"),
        F.lit("submission").alias("type"),
        F.col("event_type").alias("sentiment_label"),
        F.col("value").alias("sentiment_score"),
    )


def _trend(df: DataFrame) -> DataFrame:
    return df.select(
        _ntz("bucket"),
        F.round("avg_score", 6).alias("avg_score"),
        "posts",
        F.round("positive_ratio", 6).alias("positive_ratio"),
    )


def sentiment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = label_distribution(_scored(spark, sf_dir))
    return shares.select("sentiment_label", "posts", F.round("share", 6).alias("share"))


def scored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-chunk rule: only the first 1,536 characters of a post are scored."""
    return score_posts(untimed_posts(spark, sf_dir), max_chunks=3).select(
        "id", "sentiment_label", _score6(), "cleaned_text"
    )


def scored_whole_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_posts(untimed_posts(spark, sf_dir)).select(
        "id", "sentiment_label", _score6(), "cleaned_text"
    )


def model_scored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``scored_whole_posts``, by a Python model in the scorer slot."""
    return score_posts(untimed_posts(spark, sf_dir), ModelScorer(_stand_in())).select(
        "id", "sentiment_label", _score6(), "cleaned_text"
    )


def _stand_in(fails_on: str | None = None):
    """A model that stands in for a trained one: the lexicon rule on batches of texts.

    It is nested so that it travels to the executors by value. ``fails_on`` makes it
    raise on batches with such a text.
    """
    positive, negative = list(POSITIVE_WORDS), list(NEGATIVE_WORDS)

    def load_model():
        import numpy as np
        import pandas as pd

        # A word is not part of a longer run of letters.
        either = r"(?<![^\W\d_])(?:{})(?![^\W\d_])"

        def model(texts: list[str]) -> list[tuple[str, float]]:
            lowered = pd.Series(texts, dtype=object).str.lower()
            if fails_on and lowered.str.contains(fails_on, regex=False).any():
                raise RuntimeError("no verdict")
            p = lowered.str.count(either.format("|".join(positive))).to_numpy(float)
            n = lowered.str.count(either.format("|".join(negative))).to_numpy(float)
            labels = np.where(p > n, "POSITIVE", np.where(n > p, "NEGATIVE", "NEUTRAL"))
            return list(zip(labels, 0.5 + 0.5 * np.abs(p - n) / np.maximum(p + n, 1)))

        return model

    return load_model


def model_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model raises on posts of three communities, the others are scored."""
    failing = F.col("subreddit").isin("src1", "src2", "src3")
    posts = untimed_posts(spark, sf_dir)
    marked = posts.withColumn("title", F.when(failing, F.lit("zzfailzz")).otherwise(F.col("title")))
    scored = score_posts(marked, ModelScorer(_stand_in("zzfailzz")))
    return scored.select("id", "sentiment_label", _score6(), "score_error")


def cut_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_documents(spark, sf_dir).select("doc_id", cut_text(F.col("text")).alias("cut"))


def short_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The short-text rule on the first 0 to 4 characters of every text."""
    return (
        load_documents(spark, sf_dir)
        .select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("n"))
        .select("doc_id", "n", is_too_short(F.expr("substring(text, 1, n)")).alias("short"))
    )


def title_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = load_documents(spark, sf_dir).select(
        "doc_id", F.substring_index("text", "\n", 1).alias("text")
    )
    return detect_language(title).select("doc_id", "lang_detected")


def new_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("created_at")
    )
    return posts_since(events, AS_OF - timedelta(days=30)).select("event_id", _ntz("created_at"))


def undated_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend where views have no time and clicks no label."""
    kind = F.col("sentiment_label")
    view = _events_view(spark, sf_dir).withColumns(
        {
            "created_at": F.when(kind != "view", F.col("created_at")),
            "sentiment_label": F.when(kind != "click", kind),
        }
    )
    return _trend(sentiment_trend(view, "purchase"))


def single_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On a clock so fast that all posts share a bucket there is no trend."""
    view = _events_view(spark, sf_dir, 1_000_000)
    buckets = sentiment_trend(view, "purchase", unit="week").select(F.lit(1).alias("one"))
    both = view.select(F.lit(1).alias("post"), F.lit(None).cast("int").alias("one")).unionByName(
        buckets, allowMissingColumns=True
    )
    return both.agg(F.count("post").alias("posts"), F.count("one").alias("buckets"))


def approx_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketched number of communities is within five percent of the true one."""
    view = _events_view(spark, sf_dir)
    exact = view.agg(F.countDistinct("subreddit")).scalar()
    return headline_metrics(view, approx=True).select(
        "total_posts",
        (F.abs(F.col("unique_subreddits") - exact) <= exact * 0.05).alias(
            "communities_within_5_percent"
        ),
    )


def _events_as_posts(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("created_at"),
        F.lit("events").alias("subreddit"),
        F.col("event_type").alias("title"),
        F.lit("").alias("text"),
        F.lit("submission").alias("type"),
        F.lit(label).alias("sentiment_label"),
        F.col("value").alias("sentiment_score"),
        F.lit("").alias("cleaned_text"),
        F.lit(False).alias("score_error"),
    )


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog view over two batches, the second of which re-sends the errors."""
    path = shared_folder(spark, "events-table")
    name = "events_" + path.rsplit("-", 1)[1]
    upsert_posts(_events_as_posts(spark, sf_dir, "POSITIVE"), 0, path, AS_OF)
    again = _events_as_posts(spark, sf_dir, "NEGATIVE").where("title = 'error'")
    upsert_posts(again, 1, path, AS_OF)
    ensure_table(spark, name, path)
    return spark.table(name).select(
        "id", "subreddit", _ntz("insertion_time"), "version", "sentiment_label"
    )


def limited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "events-table")
    upsert_posts(_events_as_posts(spark, sf_dir, "POSITIVE"), 0, path, AS_OF)
    return scan_posts(spark, path, limit=25).select("id", _ntz("created_at"))


def stream_resent_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup after a replayed batch and after posts were sent again, changed.

    All posts, the same batch again, then the English ones under another text.
    """
    path = shared_folder(spark, "resent")
    write = batch_writer(path)
    documents = load_documents(spark, sf_dir)
    posts = as_posts(documents)
    edited = as_posts(documents.where(F.col("lang") == "en")).withColumn(
        "text", F.concat(F.lit("useless garbage "), F.col("text"))
    )
    write(to_messages(posts), 0)
    write(to_messages(posts), 0)
    write(to_messages(edited), 1)
    write(to_messages(edited), 1)
    await_stream(run_rollup(spark, path, f"{path}/rollup-checkpoint", {"availableNow": True}))
    rollup = read_rollup(spark, f"{path}/rollup")
    return rollup.groupBy("subreddit", "sentiment_label").agg(
        F.sum("posts").alias("posts"), F.round(F.sum("score_sum"), 4).alias("score_sum")
    )


NOW = {"availableNow": True}


def _message_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events as messages, and the errors among them again under another title."""
    events = _events_as_posts(spark, sf_dir, "").drop("sentiment_label", "sentiment_score")
    events = events.select("id", "created_at", "subreddit", "title", "text", "type")
    again = events.where("title = 'error'").withColumn("title", F.lit("best"))
    return to_messages(events), to_messages(again)


def retained_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup after the day of the first batch was dropped and its errors came again.

    Kept by the ledger stream, which is stopped and started between the steps.
    """
    path = shared_folder(spark, "retained")
    first, again = _message_batches(spark, sf_dir)

    def catch_up() -> None:
        await_stream(run_rollup(spark, path, f"{path}/rollup-checkpoint", NOW))

    batch_writer(path, as_of=AS_OF - timedelta(days=40))(first, 0)
    catch_up()
    batch_writer(path, as_of=AS_OF - timedelta(days=20))(again, 1)
    catch_up()
    drop_expired(spark, f"{path}/posts", 30, AS_OF)
    batch_writer(path, as_of=AS_OF)(again, 2)
    catch_up()
    rollup = read_rollup(spark, f"{path}/rollup")
    table = rollup_posts(scan_posts(spark, f"{path}/posts"))
    sums = [F.sum("posts").alias("posts"), F.round(F.sum("score_sum"), 4).alias("score_sum")]
    keys = ["bucket", "subreddit", "sentiment_label"]
    both = rollup.groupBy(*keys).agg(*sums).join(
        table.groupBy(*keys).agg(F.sum("posts").alias("stored")), keys, "full"
    )
    return both.select(_ntz("bucket"), "subreddit", "sentiment_label", "posts", "stored", "score_sum")


def stream_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter hours by watermark, with a tenth of the events a batch too late.

    Events come in order in the first batch, those with numbers that end in 7 in the
    second one. What is over then, in counts and as late posts.
    """
    path = shared_folder(spark, "trend")
    events = _events_as_posts(spark, sf_dir, "POSITIVE")
    late = F.endswith("id", F.lit("7"))
    for number, part in enumerate([events.where(~late), events.where(late)]):
        upsert_posts(part, number, f"{path}/posts", AS_OF)
        await_stream(run_trend(spark, path, f"{path}/trend-checkpoint", trigger=NOW))
    closed = read_trend(spark, f"{path}").select("bucket", F.lit(False).alias("late"), "posts", "score_sum")
    too_late = read_late(spark, f"{path}").select(
        floor_ts(F.col("created_at"), "15 minutes").cast("timestamp").alias("bucket"),
        F.lit(True).alias("late"),
        F.lit(1).cast("long").alias("posts"),
        F.col("sentiment_score").alias("score_sum"),
    )
    return (
        closed.union(too_late)
        .groupBy("bucket", "late")
        .agg(F.sum("posts").alias("posts"), F.round(F.sum("score_sum"), 4).alias("score_sum"))
        .select(_ntz("bucket"), "late", "posts", "score_sum")
    )


def compacted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six batches in two hours, one of them and its rollup compacted while the rest waits.

    The table, the log of batches and the number of folders that count, before and after.
    """
    path = shared_folder(spark, "windows")
    first, again = _message_batches(spark, sf_dir)
    hours = [AS_OF, AS_OF + timedelta(hours=1)]
    for number in range(6):
        batch_writer(path, as_of=hours[number // 4])(again if number % 2 else first, number)
    log = CommitLog(spark, path)
    before = log.snapshot()
    compact_windows(spark, path, hours[1] + timedelta(minutes=30))
    after = log.snapshot()
    posts = scan_posts(spark, f"{path}/posts").agg(
        F.struct(
            F.count("*").alias("posts"),
            F.countDistinct("id").alias("ids"),
            F.count_if(F.col("title") == "best").alias("best"),
        )
    )
    old = scan_posts(spark, f"{path}/posts", as_of=before.number).agg(F.count("*"))
    lines = read_folder(spark, f"{path}/batch_log").agg(
        F.struct(F.countDistinct("batch_id").alias("batches"), F.sum("rows_in").alias("rows_in"))
    )
    return (
        spark.range(1)
        .select(
            posts.scalar().alias("posts"),
            old.scalar().alias("posts_before"),
            lines.scalar().alias("lines"),
            F.lit(len(before.of("posts"))).alias("folders_before"),
            F.lit(len(after.of("posts"))).alias("folders"),
        )
        .select("posts.*", "posts_before", "lines.*", "folders_before", "folders")
    )


def _indexed_feed(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """All events in eight batches by number, the last one with errors again, indexed."""
    events = _events_as_posts(spark, sf_dir, "POSITIVE")
    number = F.col("id").cast("long")
    eighth = -(-events.count() // 8)
    log = CommitLog(spark, path)
    again = events.where("title = 'error'").withColumn("sentiment_label", F.lit("NEGATIVE"))
    for batch in range(9):
        part = again if batch == 8 else events.where(number.between(batch * eighth, (batch + 1) * eighth - 1))
        upsert_posts(part, batch, f"{path}/posts", AS_OF)
        log.commit({f"posts/batch_id={batch}": hour_of(AS_OF)}, batch=batch)
    index_files(spark, path)
    return events


def indexed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that have the number of a document, by the index of files."""
    path = shared_folder(spark, "indexed")
    _indexed_feed(spark, sf_dir, path)
    wanted = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"))
    found = lookup_posts(spark, path, wanted)
    stored = read_versions(spark, f"{path}/posts").inputFiles()
    # What is found is read from the files of the documents as well.
    opened = set(stored).intersection(found.inputFiles())
    return found.select(
        "id",
        _ntz("created_at"),
        "sentiment_label",
        F.lit(len(opened) < len(stored)).alias("files_skipped"),
    )


def newest_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 latest events of the table, by the newest post of each file."""
    path = shared_folder(spark, "indexed")
    _indexed_feed(spark, sf_dir, path)
    return newest_posts(spark, path, 25).select("id", _ntz("created_at"), "sentiment_label")


def new_files_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts at "latest": posts that were there are not read, later ones are."""
    path = shared_folder(spark, "latest")
    documents = load_documents(spark, sf_dir)
    english = F.col("lang") == "en"

    def land(part: DataFrame) -> None:
        to_messages(as_posts(part)).select("value").write.mode("append").text(f"{path}/topic")

    def read() -> None:
        topic = read_posts_stream(
            spark, "text", starting="latest", marker=f"{path}/start", path=f"{path}/topic"
        )
        await_stream(run_stream(topic, path, f"{path}/checkpoint", trigger=NOW))

    land(documents.where(~english))
    read()
    land(documents.where(english))
    read()
    return scan_posts(spark, f"{path}/posts").select("id", "subreddit", "title")


def learned_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language model learned from three quarters of the texts, told on all of them.

    At least 99 of 100 of the texts it has not seen must be told right. Whole texts, as a
    first line may be a notice in another language than the rest.
    """
    texts = load(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held_out = F.col("doc_id") % 4 == 2
    model = learn(texts.where(~held_out), "text", "lang")
    told = texts.select("lang", held_out.alias("held_out"), model.label_of(F.col("text")).alias("told"))
    right = F.count_if(F.col("held_out") & (F.col("told") == F.col("lang")))
    unseen = F.count_if("held_out")
    return told.agg(
        F.count("told").alias("told"), unseen.alias("unseen"), (right >= unseen * 0.99).alias("right")
    )


def learned_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer learned from labels, stored, read back and put into the scorer slot.

    Of the labelled posts it has not seen, good ones must score higher on average.
    """
    posts = untimed_posts(spark, sf_dir)
    labels = load(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), "quality")
    both = posts.join(labels, "id").select(
        combine_text(F.col("title"), F.col("text")).alias("text"),
        F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("label"),
        "id",
    )
    held_out = F.col("id").cast("long") % 4 == 2
    path = shared_folder(spark, "scorer")
    learn(both.where(~held_out), "text", "label", "words").save(spark, path)
    scored = score_posts(posts, LearnedModel.read(spark, path).scorer())
    good = F.when(F.col("sentiment_label") == "positive", F.col("sentiment_score")).otherwise(
        1 - F.col("sentiment_score")
    )
    told = scored.select("id", "score_error", good.alias("good")).join(labels, "id", "left")
    mean = lambda q: F.avg(F.when(held_out & (F.col("quality") == q), F.col("good")))
    return told.agg(
        F.count("*").alias("posts"),
        F.count_if("score_error").alias("errors"),
        (mean(1) > mean(0)).alias("separates"),
    )


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in four batches of as many files, and the stored progress of the stream.

    A task writes a file, so there is one for each ``TOPIC_FILE`` bytes of the documents.
    """
    path = shared_folder(spark, "progress")
    messages = to_messages(as_posts(load_documents(spark, sf_dir))).select("value")
    fs, documents = files(spark, f"{sf_dir}/documents.parquet")
    each = -(-fs.getContentSummary(documents).getLength() // (4 * TOPIC_FILE))
    messages.repartition(4 * each).write.text(f"{path}/topic")
    reporter = StreamReporter(spark, f"{path}/progress")
    spark.streams.addListener(reporter)
    try:
        topic = read_posts_stream(spark, "text", path=f"{path}/topic", max_per_batch=each)
        await_stream(run_stream(topic, path, f"{path}/checkpoint", trigger={"availableNow": True}))
        # Events come after the batch they tell of.
        reporter.wait_for("terminated")
    finally:
        spark.streams.removeListener(reporter)
    reports = read_folder(spark, f"{path}/progress").where("event = 'progress' AND rows > 0")
    told = reports.agg(F.countDistinct("batch_id")).scalar()
    return read_folder(spark, f"{path}/batch_log").agg(
        F.count("*").alias("batches"),
        F.sum("rows_in").alias("rows"),
        (F.count("*") == F.first(told)).alias("logged"),
    )


def dashboard_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every panel over a stored rollup, with its values: one long table.

    ``key`` is the community, label, bucket or post of a row; ``posts`` its count,
    ``score`` a mean or a post's score, ``share`` the share or positive ratio.
    """
    view = _events_view(spark, sf_dir)
    path = shared_folder(spark, "rollup")
    rollup_posts(view).write.parquet(path)
    panels = dashboard(view, spark.read.parquet(path))
    day = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    none = F.lit(None).cast("double")
    shown = {
        "headline": ("most_common_label", "total_posts", "avg_score", none),
        "distribution": ("sentiment_label", "posts", none, "share"),
        "communities": ("subreddit", "posts", "avg_score", none),
        "trend": (day("bucket"), "posts", "avg_score", "positive_ratio"),
        "trend_summary": ("time_grouping", "points", none, none),
        "summary": (day("newest_post"), "records", none, none),
        "recent_posts": ("id", F.lit(1), "score", none),
    }
    out = None
    for name, (key, posts, score, share) in shown.items():
        column = lambda c: F.col(c) if isinstance(c, str) else c
        one = panels[name].select(
            F.lit(name).alias("panel"),
            column(key).alias("key"),
            column(posts).cast("long").alias("posts"),
            F.round(column(score), 6).alias("score"),
            F.round(column(share), 6).alias("share"),
        )
        out = one if out is None else out.union(one)
    return out


def normalized_mentions_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.concat(
        F.lit(" \t@bob http://x.y/z  @ "),
        F.col("text"),
        F.lit(" @"),
        F.col("source"),
        F.lit(" https://"),
        F.col("source"),
        F.lit("\n\u00a0 "),
    )
    return load_documents(spark, sf_dir).select(
        "doc_id",
        normalize_mentions_links(noisy).alias("normalized"),
        strip_ws(noisy).alias("stripped"),
    )


def chunked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks of the whole texts, and whether a scorer gets to see each."""
    return (
        load_documents(spark, sf_dir)
        .select("doc_id", F.posexplode(chunk_text(F.col("text"), max_chunks=None)))
        .select(
            "doc_id",
            F.col("pos").alias("chunk_no"),
            F.col("col").alias("chunk"),
            (F.col("pos") < 3).alias("scored"),
        )
    )


def detected_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load_documents(spark, sf_dir)
    return detect_language(documents).select("doc_id", "lang_detected")


def language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_feed(untimed_posts(spark, sf_dir), language="en").select(
        "id", "subreddit", "title", "text", "type"
    )


def cleaned_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some communities' posts, padded with blanks, the German ones nothing else."""
    padded = F.when(F.col("lang") == "de", "  \n ").otherwise(
        F.concat(F.lit("\t "), F.col("text"), F.lit("  "))
    )
    posts = as_posts(load_documents(spark, sf_dir).withColumn("text", padded))
    return clean_feed(posts, communities=FEED, language=None).drop("created_at")


def feed_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of the communities that a query names: those with longer posts."""
    documents = load(spark, sf_dir, "documents")
    wanted = documents.groupBy(F.col("source").alias("subreddit")).agg(
        F.avg("n_chars").alias("length")
    )
    posts = posts_feed(as_posts(documents), wanted.where(F.col("length") > 2450))
    return posts.select("id", "subreddit", "title")


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = decode_kafka(to_messages(timed_posts(spark, sf_dir)))
    back = require_key(parse_posts(sent))
    return back.select("id", _ntz("created_at"), "subreddit", "title", "text", "type")


_PROPS = T.StructType([T.StructField("k", T.IntegerType())])


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_id", "props")
    return parse_json(events, _PROPS, "props").select("event_id", "k")


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of errors lose their end, those of sign-ups their key."""
    props = F.col("props")
    value = (
        F.when(F.col("event_type") == "error", F.substr(props, F.lit(1), F.length(props) - 1))
        .when(F.col("event_type") == "signup", F.replace(props, F.lit('"k"'), F.lit('"j"')))
        .otherwise(props)
    )
    messages = load(spark, sf_dir, "events").select("event_id", value.alias("value"))
    _, dead = split_valid(parse_json(messages, _PROPS), key="k")
    return dead.select("event_id", "value", "reason")


def viewed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The read view of events stored with missing times, texts and scores."""
    kind = F.col("event_type")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    stored = load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.when(kind != "view", seconds).otherwise(0).alias("created_at"),
        F.lit("events").alias("subreddit"),
        F.when(kind != "click", F.col("props")).alias("title"),
        F.lit(None).cast("string").alias("text"),
        F.lit("submission").alias("type"),
        kind.alias("sentiment_label"),
        F.when(kind != "error", F.col("value")).alias("sentiment_score"),
    )
    view = posts_view(stored)
    return view.select(*[_ntz(c) if c == "created_at" else F.col(c) for c in view.columns])


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floors, display text and epoch seconds of all event times."""
    ts = F.col("ts").cast("timestamp")
    times = load(spark, sf_dir, "events").select(
        "event_id",
        *[floor_ts(ts, unit).alias(f"start_{unit.split()[-1]}") for unit in UNITS],
        time_text(ts).alias("shown"),
        epoch_to_ts(ts_to_epoch(ts)).alias("back"),
    )
    stamps = [c for c in times.columns if c.startswith("start_") or c == "back"]
    return times.select("event_id", "shown", *[_ntz(c) for c in stamps])


def event_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of events as posts, some without time, some without label."""
    kind = F.col("sentiment_label")
    view = _events_view(spark, sf_dir).withColumns(
        {
            "created_at": F.when(kind != "signup", F.col("created_at")),
            "title": F.repeat(F.concat(F.lit("é"), kind, F.lit(" ")), 12),
            "text": F.when(kind != "click", F.repeat(F.concat(kind, F.lit("\n")), 70)),
            "sentiment_label": F.when(kind == "purchase", "positive")
            .when(kind == "error", "NEGATIVE")
            .when(kind != "view", "neutral"),
        }
    )
    return post_cards(view)


def headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = headline_metrics(_scored(spark, sf_dir))
    return metrics.withColumn("avg_score", F.round("avg_score", 6))


def headline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = headline_metrics(_events_view(spark, sf_dir))
    return metrics.withColumn("avg_score", F.round("avg_score", 6))


def common_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return most_common_label(_events_view(spark, sf_dir))


def trend_15min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(sentiment_trend(_events_view(spark, sf_dir, 100), "purchase"))


def trend_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(sentiment_trend(_events_view(spark, sf_dir, 40), "purchase"))


def trend_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(sentiment_trend(_events_view(spark, sf_dir, 8), "purchase"))


def trend_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(sentiment_trend(_events_view(spark, sf_dir), "purchase"))


def trend_of_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend over a stored rollup is the trend over the posts."""
    path = shared_folder(spark, "rollup")
    rollup_posts(_events_view(spark, sf_dir, 8)).write.parquet(path)
    return _trend(sentiment_trend(spark.read.parquet(path), "purchase"))


def trend_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(sentiment_trend(posts_view(score_posts(timed_posts(spark, sf_dir)))))


def trend_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = trend_summary(_events_view(spark, sf_dir))
    return facts.select(_ntz("first_post"), _ntz("last_post"), "time_grouping", "points")


def post_time_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = time_span(_events_view(spark, sf_dir))
    return span.select(
        _ntz("first_post"),
        _ntz("last_post"),
        (F.unix_micros("last_post") - F.unix_micros("first_post")).alias("span_micros"),
    )


def bucketed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucketed = adaptive_bucket(_events_view(spark, sf_dir, 100))
    return bucketed.select("id", _ntz("bucket"))


def communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = community_sentiment(_scored(spark, sf_dir))
    return groups.select("subreddit", F.round("avg_score", 6).alias("avg_score"), "posts")


def biggest_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = top_communities(_events_view(spark, sf_dir))
    return groups.select("subreddit", F.round("avg_score", 6).alias("avg_score"), "posts")


def _cards(df: DataFrame) -> DataFrame:
    # The two-decimal text is left out: rounding of exact halves differs by engine.
    return df.drop("score_text").withColumn("score", F.round("score", 6))


def all_post_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cards(post_cards(posts_view(score_posts(timed_posts(spark, sf_dir)))))


def latest_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten latest posts; they are picked before scoring, so ten are scored."""
    latest = timed_posts(spark, sf_dir).orderBy(F.desc_nulls_last("created_at"), "id").limit(10)
    return _cards(recent_posts(posts_view(score_posts(latest)), 10))


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = raw_sample(_events_view(spark, sf_dir), 3, order="id")
    return view.select("id", _ntz("created_at"), "subreddit", "sentiment_label", _score6())


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    unscored = timed_posts(spark, sf_dir).withColumns(
        {
            "sentiment_label": F.lit(None).cast("string"),
            "sentiment_score": F.lit(None).cast("double"),
        }
    )
    facts = table_summary(posts_view(unscored))
    return facts.select(_ntz("newest_post"), "records")


def column_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unscored posts checked against the columns that the read view needs."""
    return schema_report(untimed_posts(spark, sf_dir), VIEW_COLUMNS, counts=True)


def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user, as the last version of a post."""
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return latest_per_key(events, "user_id", "event_id")


def retained_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the 30 days before a fixed moment, with hour and day columns."""
    stored = load(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("ts").cast("timestamp").alias("insertion_time"),
    )
    kept = retain(with_layout_columns(stored), days=30, as_of=AS_OF)
    return kept.select("event_id", _ntz("insertion_time"), "bucket", "dt")


def stored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, one of them replayed, then compaction, then the read view.

    The second batch re-sends the English posts under a changed title.
    """
    path, target = shared_folder(spark, "posts"), shared_folder(spark, "compacted")
    documents = load_documents(spark, sf_dir)
    edited = as_posts(documents.where(F.col("lang") == "en")).withColumn(
        "title", F.concat(F.lit("edited: "), F.col("title"))
    )
    upsert_posts(score_posts(as_posts(documents)), 0, path, AS_OF)
    for _ in range(2):
        upsert_posts(score_posts(edited), 1, path, AS_OF)
    compact(spark, path, target)
    return scan_posts(spark, target).select(
        "id", "subreddit", "title", "text", "type", "sentiment_label", _score6()
    )


def _stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # A pattern, because a stream takes a plain path for a folder only.
    schema = load(spark, sf_dir, name).schema
    return read_posts_stream(spark, "parquet", schema, path=f"{sf_dir}/{{{name}}}.parquet")


def stream_scored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a stream of messages through the whole streaming job."""
    path = shared_folder(spark, "stream")
    messages = to_messages(as_posts(_stream_of(spark, sf_dir, "documents")))
    await_stream(
        run_stream(messages, path, f"{path}/checkpoint", trigger={"availableNow": True})
    )
    return latest_posts(read_versions(spark, f"{path}/posts")).select(
        "id", "sentiment_label", _score6(), "cleaned_text"
    )


def stream_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts through both streaming jobs, with message files between them."""
    path = shared_folder(spark, "feed")
    raw = as_posts(_stream_of(spark, sf_dir, "documents"))
    once = {"availableNow": True}
    await_stream(
        run_feed(raw, f"{path}/feed", "text", once, communities=FEED, path=f"{path}/topic")
    )
    topic = read_posts_stream(spark, "text", path=f"{path}/topic")
    await_stream(run_stream(topic, f"{path}/out", f"{path}/scoring", trigger=once))
    return scan_posts(spark, f"{path}/out/posts").select(
        "id", "subreddit", "title", "text", "type", "sentiment_label", _score6()
    )


def _with_broken_messages(messages: DataFrame) -> DataFrame:
    """Messages of one community lose their end, those of another their id."""
    value = (
        F.when(F.contains("value", F.lit('"subreddit":"src7"')), F.substring("value", 1, 9))
        .when(
            F.contains("value", F.lit('"subreddit":"src9"')),
            F.replace("value", F.lit('"id":'), F.lit('"no":')),
        )
        .otherwise(F.col("value"))
    )
    return messages.withColumn("value", value)


def stream_batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts that the streaming job logs where some messages are broken."""
    path = shared_folder(spark, "stream")
    posts = as_posts(_stream_of(spark, sf_dir, "documents"))
    messages = _with_broken_messages(to_messages(posts))
    await_stream(
        run_stream(messages, path, f"{path}/checkpoint", trigger={"availableNow": True})
    )
    log = read_folder(spark, f"{path}/batch_log")
    counts = ["rows_in", "rows_valid", "rows_dead", "rows_written"]
    return log.agg(*[F.sum(c).alias(c) for c in counts])


def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of scored posts into a rollup table."""
    path = shared_folder(spark, "rollup")
    posts = _stream_of(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.lit("events").alias("subreddit"),
        F.lit("").alias("title"),
        F.lit("").alias("text"),
        F.lit("submission").alias("type"),
        F.col("event_type").alias("sentiment_label"),
        F.col("value").alias("sentiment_score"),
    )
    await_stream(
        refresh_rollups(posts, f"{path}/parts", f"{path}/checkpoint", {"availableNow": True})
    )
    return read_rollup(spark, f"{path}/parts").select(
        _ntz("bucket"),
        "subreddit",
        "sentiment_label",
        "posts",
        "scored",
        F.round("score_sum", 4).alias("score_sum"),
        _ntz("first_post"),
        _ntz("last_post"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sentiment_distribution": sentiment_distribution,
    "scored_posts": scored_posts,
    "scored_whole_posts": scored_whole_posts,
    "model_scored_posts": model_scored_posts,
    "normalize_mentions_links": normalized_mentions_links,
    "chunk_text": chunked_text,
    "detect_language": detected_language,
    "language_filter": language_filter,
    "clean_feed": cleaned_feed,
    "feed_by_table": feed_by_table,
    "json_roundtrip": json_roundtrip,
    "event_props": event_props,
    "dead_letters": dead_letters,
    "posts_view": viewed_posts,
    "event_times": event_times,
    "event_cards": event_cards,
    "headline_metrics": headline,
    "headline_metrics_events": headline_events,
    "most_common_label": common_label,
    "trend_15min": trend_15min,
    "trend_hourly": trend_hourly,
    "trend_daily": trend_daily,
    "trend_weekly": trend_weekly,
    "trend_of_rollup": trend_of_rollup,
    "trend_posts": trend_posts,
    "trend_summary": trend_facts,
    "time_span": post_time_span,
    "adaptive_bucket": bucketed_events,
    "community_sentiment": communities,
    "top_communities": biggest_communities,
    "post_cards": all_post_cards,
    "recent_posts": latest_cards,
    "raw_sample": sample_rows,
    "table_summary": summary,
    "schema_report": column_report,
    "latest_per_id": latest_versions,
    "retained_posts": retained_events,
    "stored_posts": stored_posts,
    "stream_scored_posts": stream_scored_posts,
    "stream_feed": stream_feed,
    "stream_batch_log": stream_batch_log,
    "stream_rollup": stream_rollup,
    "cut_texts": cut_texts,
    "title_language": title_language,
    "short_posts": short_posts,
    "new_posts": new_posts,
    "undated_trend": undated_trend,
    "single_bucket": single_bucket,
    "approx_headline": approx_headline,
    "stored_events": stored_events,
    "limited_scan": limited_scan,
    "model_errors": model_errors,
    "stream_resent_rollup": stream_resent_rollup,
    "stream_progress": stream_progress,
    "dashboard_panels": dashboard_panels,
    "retained_rollup": retained_rollup,
    "stream_trend": stream_trend,
    "compacted_windows": compacted_windows,
    "indexed_lookup": indexed_lookup,
    "newest_stored": newest_stored,
    "new_files_only": new_files_only,
    "learned_language": learned_language,
    "learned_scores": learned_scores,
}
