"""What the plans must and must not contain, whatever the size of the data."""

import re

import pytest

import __spark_entry__ as entry
from feedpulse.operators.metrics import sentiment_trend
from feedpulse.operators.scoring import ModelScorer, score_posts
from feedpulse.plans.catalog import QUERIES, _events_view
from feedpulse.plans.posts import untimed_posts
from feedpulse.sources.feed import clean_feed

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_of(q(spark, SF_DIR)) for n, q in QUERIES.items()}


def test_no_cross_joins_and_no_single_task_windows(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "NestedLoop" not in plan, name
        assert not re.search(r"\bWindow \[", plan), name


def test_python_runs_for_models_only(plans):
    python = {n for n, p in plans.items() if "EvalPython" in p or "InPandas" in p}
    assert python == {"model_scored_posts", "model_errors", "learned_language", "learned_scores"}


def test_scans_read_only_what_is_used(plans):
    assert scans(plans["sentiment_distribution"])[0] == "text:string"
    assert scans(plans["detect_language"])[0] == "doc_id:bigint,text:string"
    assert scans(plans["latest_per_id"])[0].count(":") == 4
    assert scans(plans["table_summary"])[0] == "doc_id:bigint"


def test_scoring_and_cleaning_need_no_shuffle(spark, plans):
    posts = untimed_posts(spark, SF_DIR)
    for plan in (plan_of(posts), plan_of(score_posts(posts)), plans["clean_feed"]):
        assert "Exchange" not in plan
    for name in ("detect_language", "title_language", "language_filter"):
        assert "Exchange" not in plans[name], name


def test_language_is_told_once_under_its_filter(spark):
    kept = clean_feed(untimed_posts(spark, SF_DIR), language="en")
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1


def test_a_model_runs_once_per_post_even_under_a_filter(spark):
    scored = score_posts(
        untimed_posts(spark, SF_DIR), ModelScorer(lambda: lambda t: [("positive", 0.7)] * len(t))
    )
    for df in (scored, scored.where("sentiment_label = 'positive' and sentiment_score > 0.5")):
        plan = plan_of(df)
        assert plan.count("ArrowEvalPython") == 1
        assert len(re.findall(r"ArrowEvalPython \[score\(", plan)) == 1
    assert df.count() == scored.count() > 0


def test_label_shares_score_once(spark):
    shares = entry.queries()["sentiment_distribution"](spark, SF_DIR)
    shares.collect()
    assert "ReusedExchange" in plan_of(shares)


def test_span_of_a_trend_reads_times_only(spark):
    trend = sentiment_trend(_events_view(spark, SF_DIR))
    assert set(scans(plan_of(trend))) == {
        "ts:timestamp_ntz",
        "ts:timestamp_ntz,event_type:string,value:double",
    }


def test_superseded_rows_are_combined_before_the_shuffle(plans):
    plan = plans["latest_per_id"]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in plan


def test_topic_files_grow_in_number_not_in_size(spark, monkeypatch):
    from feedpulse.plans import catalog

    written = []
    stream = catalog.read_posts_stream
    monkeypatch.setattr(catalog, "TOPIC_FILE", 20_000, raising=False)
    monkeypatch.setattr(
        catalog,
        "read_posts_stream",
        lambda s, *a, **o: written.append(len(s.read.text(o["path"]).inputFiles())) or stream(s, *a, **o),
    )
    row = catalog.stream_progress(spark, SF_DIR).first()
    assert row.asDict() == {"batches": 4, "rows": 200, "logged": True}
    assert written[0] > 4 and written[0] % 4 == 0
