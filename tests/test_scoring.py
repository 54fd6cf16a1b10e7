"""The scorer slot: rules around it, the lexicon, models that work and that fail."""

import os

import pytest
from pyspark.sql import functions as F

from feedpulse.functions.wordlists import NEGATIVE_WORDS, POSITIVE_WORDS
from feedpulse.operators.scoring import LexiconScorer, ModelScorer, check_scorer, score_posts


def posts(spark, *rows):
    return spark.createDataFrame(
        [(str(i), title, text) for i, (title, text) in enumerate(rows)],
        "id string, title string, text string",
    )


def results(df):
    return [
        (r.sentiment_label, r.sentiment_score, r.cleaned_text, r.score_error)
        for r in df.orderBy(F.col("id").cast("int")).collect()
    ]


def scripted_scorer(batch_chunks=64):
    """A model whose label and confidence stand in the text; ``boom`` raises.

    Nested, so that it reaches the workers by value.
    """

    def load():
        def model(texts):
            out = []
            for text in texts:
                if "boom" in text:
                    raise RuntimeError("boom")
                words = text.split()
                score = {"low": 0.6, "high": 0.9}.get(words[-1], 0.7)
                out.append({"label": words[0].upper(), "score": score})
            return out

        return model

    return ModelScorer(load, batch_chunks)


def test_word_lists_do_not_overlap():
    assert not set(POSITIVE_WORDS) & set(NEGATIVE_WORDS)


def test_short_texts_are_neutral(spark):
    df = posts(spark, (None, None), ("ok", None), ("", " ok "), ("  ", "\n"))
    assert results(score_posts(df)) == [("neutral", 0.5, "", False)] * 4


def test_lexicon(spark):
    df = posts(
        spark,
        ("bad", ""),
        ("Great!", "I love it, LOVE it."),
        ("good", "bad"),
        ("Nothing", "to see"),
        ("great great", "awful"),
        ("@good http://bad", "goodness"),
    )
    assert results(score_posts(df)) == [
        ("negative", 1.0, "bad ", False),
        ("positive", 1.0, "Great! I love it, LOVE it.", False),
        ("neutral", 0.5, "good bad", False),
        ("neutral", 0.5, "Nothing to see", False),
        ("positive", 0.5 + 0.5 * 1 / 3, "great great awful", False),
        ("neutral", 0.5, "@user http goodness", False),
    ]


def test_best_chunk_and_tie(spark):
    blank = "x " * 253 + "yyyyyy"
    tie = ("good " + "x" * 507) + ("bad " + "x" * 508)
    later = ("good bad bad " + "x" * 499) + ("good " + "x" * 507)
    fourth = "z" * 1536 + " bad"
    assert len(tie) == len(later) == 1024 and len(blank) == 512
    df = posts(spark, (tie, None), (later, None), (fourth, None))
    got = results(score_posts(df, max_chunks=3))
    assert [(label, score) for label, score, _, _ in got] == [
        ("positive", 1.0),
        ("positive", 1.0),
        ("neutral", 0.5),
    ]
    # Stored texts are whole, and whole texts are scored unless told otherwise.
    assert [len(text) for _, _, text, _ in got] == [1025, 1025, 1541]
    whole = results(score_posts(posts(spark, (fourth, None))))
    assert whole[0][:2] == ("negative", 1.0)


@pytest.mark.parametrize(
    "verdicts",
    [
        lambda texts: [("positive", 0.9)] * (len(texts) + 1),
        lambda texts: [("positive", 0.9)] * (len(texts) - 1),
        lambda texts: [("bogus_label", 0.9)] * len(texts),
        lambda texts: [("positive", 7.5)] * len(texts),
        lambda texts: [("positive", -0.1)] * len(texts),
        lambda texts: [("positive", float("nan"))] * len(texts),
        lambda texts: [("positive", None)] * len(texts),
    ],
)
def test_model_results_are_checked(spark, verdicts):
    got = results(score_posts(posts(spark, ("one", None), ("two", None)), ModelScorer(lambda: verdicts)))
    assert [(label, score, error) for label, score, _, error in got] == [("neutral", 0.5, True)] * 2


def test_model_scorer_picks_best_chunk(spark):
    def long(first, second):
        one, two = (f"{word} {'x' * 600}" for word in (first, second))
        return one[:508] + " low" + two[:506] + " high"

    text = long("positive", "negative")
    assert len(text) == 1023  # the missing body adds a space
    df = posts(spark, ("positive", "thing"), (text, None), ("a", ""))
    got = results(score_posts(df, scripted_scorer()))
    assert got[0] == ("positive", 0.7, "positive thing", False)
    assert got[1][:2] == ("negative", 0.9)
    assert got[2] == ("neutral", 0.5, "", False)


@pytest.mark.parametrize("batch_chunks", [1, 3, 64])
def test_failing_posts_do_not_take_others_down(spark, batch_chunks):
    rows = [("boom", "x" * 600) if i % 4 == 0 else ("positive", str(i)) for i in range(20)]
    got = results(score_posts(posts(spark, *rows), scripted_scorer(batch_chunks)))
    for (title, text), (label, score, cleaned, error) in zip(rows, got):
        if title == "boom":
            # The reference result for a failed post is its whole normalised text.
            assert (label, score, error) == ("neutral", 0.5, True)
            assert cleaned == f"{title} {text}"
        else:
            assert (label, score, error) == ("positive", 0.7, False)


def test_a_worker_loads_the_model_once(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        with open(f"{folder}/{os.getpid()}", "a") as f:
            f.write("loaded\n")
        return lambda texts: [("positive", 0.75) for _ in texts]

    scorer = ModelScorer(load)
    df = posts(spark, *[("some", str(i)) for i in range(64)]).repartition(16, "id")
    for _ in range(3):
        assert score_posts(df, scorer).where("sentiment_score = 0.75").count() == 64
    loads = [p.read_text() for p in tmp_path.iterdir()]
    assert loads and set(loads) == {"loaded\n"}
    other = ModelScorer(lambda: lambda texts: [("negative", 0.6) for _ in texts])
    assert score_posts(df, other).where("sentiment_label = 'negative'").count() == 64


def test_model_that_returns_too_little(spark):
    df = posts(spark, ("positive", "one"), ("positive", "two"))
    got = results(score_posts(df, ModelScorer(lambda: lambda texts: [])))
    assert [g[3] for g in got] == [True, True]


def test_check_scorer(spark):
    check_scorer(spark, LexiconScorer())
    for load in (
        lambda: lambda texts: [("angry", 0.5) for _ in texts],
        lambda: lambda texts: [("positive", 1.5) for _ in texts],
        lambda: lambda texts: 1 / 0,
    ):
        with pytest.raises(ValueError):
            check_scorer(spark, ModelScorer(load))


def test_other_columns_survive(spark):
    df = posts(spark, ("good", "day")).withColumn("extra", F.lit(7))
    assert score_posts(df).columns == [
        "id",
        "title",
        "text",
        "extra",
        "sentiment_label",
        "sentiment_score",
        "cleaned_text",
        "score_error",
    ]
