"""The gates of six kinds of sources, in their order, with a language provider that may be a column or a trained model."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from corpusloom.operators.gates import first_reason

# Letters that count, front matter by slug and by title, and words that a broken font mapping leaves.
LATIN, POLISH = "[a-zA-Z\\u00C0-\\u024F]", "[A-Za-zĄĆĘŁŃÓŚŹŻąćęłńóśźż]"
FRONT_SLUG = "^(?:przedmowa|skorowidz|bibliografia|rozdzial-[0-9]+$)|bibliografia"
FRONT_TITLE = "(?i)^(informacj[ae]\\s+o\\s+e-podr|bibliografia|spis\\s)"
GARBLED = ("widad", "dad", "mied", "byd", "kooca", "przestrzeo", "poznad", "zostad", "współgrad", "uwzględnid", "zamieścid")


@dataclass(frozen=True)
class Given:
    """Languages that are known already, as columns."""

    language: str = "language"
    confidence: str = "confidence"

    def of(self, text: Column) -> Column:
        return F.struct(F.col(self.language).alias("language"), F.col(self.confidence).cast("double").alias("confidence"))


SAID = StructType([StructField("language", StringType()), StructField("confidence", DoubleType())])


class Trigrams:
    """Naive Bayes on letter trigrams: the likeliest language and its probability. Texts without a trigram are unknown, with confidence 0."""

    def __init__(self, languages: list[str], weights: dict[str, list[float]], unseen: list[float], prefix: int):
        self.languages, self.weights, self.unseen, self.prefix = languages, {k: np.array(v) for k, v in weights.items()}, np.array(unseen), prefix

    @classmethod
    def train(cls, rows: DataFrame, language: str = "lang", most: int = 4000, prefix: int = 20_000) -> Trigrams:
        """From all of ``rows`` (language, text) with a language: counts of trigrams in the first ``prefix`` code points, the ``most`` frequent of each language kept."""
        low = F.lower(F.left(F.coalesce("text", F.lit("")), F.lit(prefix)))
        plain = F.regexp_replace(low, r"[^\p{L}]+", " ")
        grams = F.when(F.length("t") >= 3, F.transform(F.sequence(F.lit(1), F.length("t") - 2), lambda k: F.substring(F.col("t"), k, F.lit(3))))
        counted = rows.where(F.col(language).isNotNull()).select(F.col(language).alias("l"), plain.alias("t")).select("l", F.explode(grams).alias("g")).groupBy("l", "g").agg(F.count(F.lit(1)).alias("n"))
        total = Window.partitionBy("l")
        kept = counted.select("l", "g", "n", F.sum("n").over(total).alias("all"), F.row_number().over(total.orderBy(F.desc("n"), "g")).alias("k")).where(F.col("k") <= most).collect()
        languages = sorted({r["l"] for r in kept})
        sums = {r["l"]: r["all"] for r in kept}
        counts: dict[str, dict[str, int]] = {}
        for r in kept:
            counts.setdefault(r["g"], {})[r["l"]] = r["n"]
        score = lambda n, of: math.log((n + 0.5) / (of + 0.5 * most))
        weights = {g: [score(own.get(x, 0), sums[x]) for x in languages] for g, own in counts.items()}
        return cls(languages, weights, [score(0, sums[x]) for x in languages], prefix)

    def classify(self, text: str | None) -> tuple[str, float]:
        plain = "".join(c if c.isalpha() else " " for c in (text or "")[: self.prefix].lower())
        plain = " ".join(plain.split()) if not plain.strip() else f" {' '.join(plain.split())} "
        found = [self.weights.get(plain[k : k + 3], self.unseen) for k in range(len(plain) - 2)]
        if not found or not self.languages:
            return "unknown", 0.0
        logs = np.sum(found, axis=0)
        shares = np.exp(logs - logs.max())
        return self.languages[int(shares.argmax())], float(shares.max() / shares.sum())

    def of(self, text: Column) -> Column:
        @F.pandas_udf(SAID)
        def said(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([self.classify(x) for x in texts], columns=["language", "confidence"])

        return said(text)


Provider = Given | Trigrams


@dataclass(frozen=True)
class Gate:
    """A reason and when it holds. One that ``overrides`` is given whatever else holds, the last such one of several."""

    reason: str
    holds: Column
    overrides: bool = False


def reason_of(gates: list[Gate]) -> Column:
    """The first reason that holds, or the overriding one; null if none does. A null condition doesn't hold."""
    plain = [(g.reason, g.holds) for g in gates if not g.overrides]
    strong = [(g.reason, g.holds) for g in reversed(gates) if g.overrides]
    return F.coalesce(*([first_reason(strong)] if strong else []), *([first_reason(plain)] if plain else []), F.lit(None).cast("string"))


def share(letters: str, text: Column) -> Column:
    return F.regexp_count(text, F.lit(letters)) / F.greatest(F.length(text), F.lit(1))


def named(authors: Column) -> Column:
    """Whether there is an author; null counts as none."""
    return F.coalesce(F.size(authors) > 0, F.lit(False))


def foreign(sure: float, wanted: str) -> Column:
    """Text in another language, if that is certain enough; ``said`` is the provider's answer."""
    return (F.col("said.language") != wanted) & (F.col("said.confidence") >= sure)


def textbook(text: Column, wanted: str) -> list[Gate]:
    return [
        Gate("frontmatter_index_bibliography_or_answer_key", F.col("slug").rlike(FRONT_SLUG)),
        Gate("unconverted_math", F.col("math_failed") > 0),
        Gate("too_short", F.length(text) < 200),
        Gate("low_letter_ratio", F.col("latin") < 0.35),
        Gate("high_confidence_non_polish", foreign(0.99, wanted)),
    ]


def chemistry(text: Column, wanted: str) -> list[Gate]:
    return [
        Gate("frontmatter_or_bibliography", F.col("title").rlike(FRONT_TITLE)),
        Gate("too_short", F.length(text) < 200),
        Gate("unbalanced_math", F.col("math_unbalanced")),
        Gate("low_letter_ratio", F.col("latin") < 0.35),
        Gate("non_polish", foreign(0.99, wanted)),
        Gate("missing_authorship", ~named(F.col("authors")), overrides=True),
    ]


def lesson(text: Column, wanted: str) -> list[Gate]:
    return [
        Gate("license_not_explicit_on_page_and_xml", ~(F.coalesce("license_on_page", F.lit(False)) & F.coalesce("license_in_source", F.lit(False)))),
        Gate("missing_creator", ~named(F.col("authors"))),
        Gate("too_short", F.length(text) < 300),
        Gate("non_polish", foreign(0.99, wanted)),
    ]


def guide(text: Column, wanted: str) -> list[Gate]:
    plain = F.octet_length(text) == F.length(text)  # ASCII alone has none of the characters looked for
    garbled = F.transform(F.array(F.lower(text)), lambda low: sum((F.regexp_count(low, F.lit(word)) for word in GARBLED), F.lit(0)))[0]  # bound: lower case is made once
    return [
        Gate("rights_or_authorship_conflict", F.col("rights_conflict")),
        Gate("page_extraction_failure", F.col("page_failures") > 0),
        Gate("text_extraction_garbled", ~plain & text.rlike("[\\u0080-\\u009F\\uFFFD]")),
        Gate("text_extraction_split_diacritics", ~plain & text.rlike("\\p{Mn}")),
        Gate("text_extraction_legacy_font_mapping", garbled > 10),
        Gate("too_little_extractable_text", F.length(text) < 1000),
        Gate("low_letter_ratio", F.col("polish") < 0.55),
        Gate("non_polish", foreign(0.98, wanted)),
    ]


def academic(text: Column, wanted: str, glyphs: int = 5, glyph_share: float = 0.00001) -> list[Gate]:
    """More than ``glyphs`` unreadable ones, or than ``glyph_share`` of the text, are too many."""
    unread = F.regexp_count(text, F.lit("\\uFFFD"))
    return [
        Gate("too_little_extractable_text", F.length(text) < 5000),
        Gate("low_letter_ratio", F.col("polish") < 0.55),
        Gate("excessive_unreadable_glyphs", (unread > glyphs) | (unread / F.greatest(F.length(text), F.lit(1)) > glyph_share)),
        Gate("non_polish", foreign(0.95, wanted)),
    ]


def notice(text: Column, wanted: str) -> list[Gate]:
    return [
        Gate("replacement_character", F.contains(text, F.lit("\uFFFD"))),
        Gate("missing_contracting_authority", ~named(F.col("authors"))),
        Gate("too_short_after_cleaning", F.length(text) < 300),
        Gate("non_polish", foreign(0.98, wanted)),
    ]


SOURCES: dict[str, Callable[[Column, str], list[Gate]]] = {f.__name__: f for f in (textbook, chemistry, lesson, guide, academic, notice)}


def judged(rows: DataFrame, kinds: list[str], provider: Provider, wanted: str = "pl", sources: dict[str, Callable[[Column, str], list[Gate]]] = SOURCES) -> DataFrame:
    """``rows`` with ``reasons``: for each of the ``kinds`` of ``sources`` the reason that rejects the row, or null.

    ``rows`` has text (null counts as empty) and what the gates of the kinds look at: slug, title,
    authors, math_failed, math_unbalanced, license_on_page, license_in_source, rights_conflict,
    page_failures. The language is asked for once a row, and shares of letters are found once,
    if a kind asks for them. Columns named said, latin, polish and reasons are replaced.
    """
    text = F.coalesce("text", F.lit(""))
    asked = rows.withColumns({"said": provider.of(text), "latin": share(LATIN, text), "polish": share(POLISH, text)})
    reasons = F.array(*(F.struct(F.lit(k).alias("kind"), reason_of(sources[k](text, wanted)).alias("reason")) for k in kinds))
    return asked.withColumn("reasons", reasons).drop("said", "latin", "polish")
