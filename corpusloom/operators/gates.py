"""Ordered gates: the first reason that applies rejects a row, and every row keeps its reason."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X


def first_reason(gates: list[tuple[str, Column]]) -> Column:
    """The name of the first gate that holds, or null."""
    (name, holds), *rest = gates
    return reduce(lambda chain, g: chain.when(g[1], g[0]), rest, F.when(holds, name))


def sentence_gates(text: Column) -> list[tuple[str, Column]]:
    return [
        ("too_short", F.length(text) < 12),
        ("too_long", F.length(text) > 500),
        ("control_character", text.rlike(X.CONTROL)),
        ("html", text.rlike(X.HTML_TAG)),
        ("url", text.rlike(X.URL)),
        ("email", text.rlike(X.EMAIL)),
        ("pesel_like", text.rlike(X.NATIONAL_NUMBER)),
        ("phone_like", text.rlike(X.PHONE)),
        ("repeated_character", text.rlike(X.REPEATED)),
        ("low_letter_ratio", (X.letters(text) < 6) | (X.letter_ratio(text) < 0.45)),
    ]


@dataclass(frozen=True)
class Profile:
    """The thresholds with which one kind of source is gated; None switches a gate off."""

    name: str
    least_chars: int
    ratio: float | None = None
    replacement: int | None = None
    languages: tuple[str, ...] = field(default=())


#: Least length and letter ratio of each kind of source.
PROFILES = (
    Profile("textbook", 200, 0.35),
    Profile("chemistry", 200, 0.35),
    Profile("lesson", 300),
    Profile("guide", 1000, 0.55, 0),
    Profile("academic", 5000, 0.55, 5),
    Profile("notice", 300, None, 0),
)


def profile_gates(profile: Profile, text: Column, lang: Column) -> list[tuple[str, Column]]:
    gates = []
    if profile.replacement is not None:
        gates.append(("replacement_characters", F.regexp_count(text, F.lit("�")) > profile.replacement))
    gates.append(("too_short", F.length(text) < profile.least_chars))
    if profile.ratio is not None:
        gates.append(("low_letter_ratio", X.letter_ratio(text) < profile.ratio))
    if profile.languages:
        gates.append(("language", ~lang.isin(*profile.languages)))
    return gates


def exact_keep_first(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """``rows`` with ``duplicate_of``: the first row's ``order`` value in each key group, null on the first row itself.

    A group's first is an aggregate joined back, so no task sorts a whole group. Null is a key like others.
    """
    keyed = rows.withColumn("_key", F.coalesce(F.sha2(key, 256), F.lit("")))
    firsts = keyed.groupBy("_key").agg(F.min(order).alias("_first"))
    return keyed.join(firsts, "_key").withColumn("duplicate_of", F.when(F.col(order) != F.col("_first"), F.col("_first"))).drop("_key", "_first")
