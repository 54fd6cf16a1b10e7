"""Language identification from function words, and from letters where those are few."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedpulse.functions.wordlists import LANGUAGE_PROFILES, LETTER_PROFILES

LETTER_RUNS = r"[^\p{L}]+"
#: From this many function words on they decide alone.
ENOUGH_WORDS = 3
#: Points of a function word beside letter groups, and the least that tell a language.
WORD_POINTS = 2
LEAST_POINTS = 2


def group_points(group: str) -> int:
    """Longer groups and letters beyond ASCII tell more."""
    return max(len(group) - 1, 1 if group.isascii() else 2)


def language_of(
    col: Column,
    profiles: Mapping[str, Sequence[str]] = LANGUAGE_PROFILES,
    letters: Mapping[str, Sequence[str]] = LETTER_PROFILES,
) -> Column:
    """The most likely language; null where a text gives too little sign of any.

    A text with ``ENOUGH_WORDS`` function words has the language of most of them. In a
    shorter one, a title say, each counts ``WORD_POINTS`` and the letter groups of a
    language count as well. Ties go to the language first by name. All of it is
    inside the row, so there is no shuffle and no state, and the same expression
    serves a stream; the letters are only looked at where words are few.
    """
    known = sorted({word for words in profiles.values() for word in words})

    def count(found: Column, words: Sequence[str]) -> Column:
        return F.size(F.filter(found, lambda t: t.isin(*words)))

    def points(text: Column, groups: Sequence[str]) -> Column:
        total = F.lit(0)
        for group in groups:
            less = F.length(text) - F.length(F.replace(text, F.lit(group), F.lit("")))
            total = total + (less / len(group)).cast("int") * group_points(group)
        return total

    def best(score) -> Column:
        return F.array_max(
            F.array(
                *[
                    F.struct(score(lang).alias("score"), F.lit(-rank).alias("rank"), F.lit(lang).alias("lang"))
                    for rank, lang in enumerate(sorted(profiles))
                ]
            )
        )

    def pick(x: Column) -> Column:
        few = lambda lang: (
            count(x["hits"], profiles[lang]) * WORD_POINTS + points(x["text"], letters.get(lang, ()))
        )
        return F.when(
            F.size(x["hits"]) >= ENOUGH_WORDS, best(lambda lang: count(x["hits"], profiles[lang]))
        ).otherwise(best(few))

    # One-element arrays bind what is used more than once.
    bound = F.transform(
        F.array(F.lower(col)),
        lambda text: F.struct(
            text.alias("text"),
            F.filter(F.split(text, LETTER_RUNS), lambda t: t.isin(*known)).alias("hits"),
        ),
    )
    won = F.transform(
        bound,
        lambda x: F.struct(
            pick(x).alias("best"),
            F.when(F.size(x["hits"]) >= ENOUGH_WORDS, 1).otherwise(LEAST_POINTS).alias("least"),
        ),
    )
    told = F.filter(won, lambda x: x["best"]["score"] >= x["least"])
    return F.get(told, F.lit(0))["best"]["lang"]


def detect_language(
    df: DataFrame,
    col: str = "text",
    profiles: Mapping[str, Sequence[str]] = LANGUAGE_PROFILES,
    into: str = "lang_detected",
) -> DataFrame:
    return df.withColumn(into, language_of(F.col(col), profiles))


def keep_language(df: DataFrame, lang: str = "en", col: str = "lang_detected") -> DataFrame:
    """Rows in one language; rows without a detected language are dropped."""
    return df.where(F.col(col) == lang)
