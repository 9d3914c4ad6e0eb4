"""Column builders that mend extracted text and take it apart: wrapped lines, page numbers, slices, paths, terms, dates."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Small letters that go on with a word or sentence, ends of sentences, and sizes of text windows.
SMALL = "a-ząćęłńóśźż"
ENDS = ".!?:;"
WINDOWS = (400, 700, 2000, 4000, 6000, 12000, 20000, 30000)

# Terms that tell the kind of an author, the first kind with a term in the text wins.
AUTHORS = {
    "trade_union": ("związek zawodowy", "zwiazek zawodowy", "solidarność"),
    "employer_organization": ("pracodawców", "pracodawcow", "konfederacja lewiatan"),
    "ngo": ("fundacja", "stowarzyszenie", "instytut"),
    "professional_body": ("izba", "samorząd", "samorzad", "rada adwokacka", "lekarska"),
    "company": ("sp. z o.o.", "spółka", "spolka", " s.a.", " sa "),
    "public_body": ("główny inspektor", "glowny inspektor", "prezes urzędu", "prezes urzedu"),
    "individual": ("osoba fizyczna", "obywatel", "obywatelka"),
}


def settled_newlines(text: Column) -> Column:
    """No blanks before line feeds, at most two empty lines in a row, one line feed at the end unless nothing stays."""
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t]+\n", "\n"), r"\n{4,}", "\n\n\n")
    text = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.when(text == "", text).otherwise(F.concat(text, F.lit("\n")))


def stripped_lines(text: Column) -> Column:
    """Each line with blanks collapsed and none at its ends."""
    return F.array_join(F.transform(F.split(text, r"\r\n|[\n\r\u0085\u2028\u2029]"), lambda x: F.regexp_replace(F.regexp_replace(x, r"[ \t\u00A0]+", " "), r"(?U)^\s+|\s+$", "")), "\n")


def without_page_numbers(text: Column, digits: int = 4) -> Column:
    """Lines of one to ``digits`` digits and nothing else go."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line.rlike(rf"\A[0-9]{{1,{digits}}}\z")), "\n")


def unhyphenated(text: Column) -> Column:
    """Words that a hyphen splits at the end of a line become whole."""
    return F.regexp_replace(text, rf"(?<=[\p{{L}}\p{{N}}_])-\n(?=[{SMALL}])", "")


def unwrapped(text: Column) -> Column:
    """A line feed inside a sentence becomes a blank: no end of a sentence or paragraph before, a small letter behind."""
    return F.regexp_replace(text, rf"(?<![{ENDS}\n])\n(?=[{SMALL}])", " ")


def repaired(text: Column) -> Column:
    """Lines are stripped first: a number, a hyphen or the end of a sentence may have blanks behind it."""
    return settled_newlines(unwrapped(unhyphenated(without_page_numbers(stripped_lines(text)))))


def both_ends(items: Column, n: int = 3) -> Column:
    """The first ``n`` and the last ``n`` items; in short arrays those that are both come twice."""
    return F.concat(F.slice(items, 1, n), F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), n))


def path_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def path_suffix(path: Column) -> Column:
    """The last dot of the name and what is behind it; empty where the name has none inside."""
    return F.regexp_extract(path_name(path), r"(?s).(\.[^.]+)\z", 1)


def path_stem(path: Column) -> Column:
    """The name without its suffix."""
    name = path_name(path)
    return F.left(name, F.length(name) - F.length(path_suffix(path)))


def first_class(text: Column, terms: dict[str, tuple[str, ...]], otherwise: str) -> Column:
    """The first key of ``terms`` of which a term is in the text, whatever the case."""
    low, done = F.lower(text), F.lit(otherwise)
    for name, own in reversed(terms.items()):
        done = F.when(F.exists(F.array(*map(F.lit, own)), lambda term: F.contains(low, term)), name).otherwise(done)
    return done


def author_kind(name: Column, text: Column) -> Column:
    return first_class(F.concat_ws("\n", name, F.left(text, F.lit(4000))), AUTHORS, "unknown")


def unbalanced_math(text: Column) -> Column:
    """Whether the numbers of opening and closing math delimiters differ."""
    count = lambda mark: F.regexp_count(text, F.lit(mark))
    return (count(r"\\\(") != count(r"\\\)")) | (count(r"\\\[") != count(r"\\\]"))


def pdf_date(raw: Column) -> Column:
    """``D:yyyymmdd...`` as a date in text; ``unknown`` if there is none from 1990 until this year."""
    year, month, day = (F.regexp_extract(raw, r"D:([0-9]{4})([0-9]{2})([0-9]{2})", k) for k in (1, 2, 3))
    number = lambda x: x.try_cast("int")
    fits = number(year).between(1990, F.year(F.current_date())) & number(month).between(1, 12) & number(day).between(1, 31)
    return F.when(fits, F.concat_ws("-", year, month, day)).otherwise("unknown")


@F.pandas_udf(StringType())
def canonical_sha256(values: pd.Series) -> pd.Series:
    """SHA-256 of a JSON text's compact form with sorted keys; null for null."""

    def one(value: str) -> str:
        whole = json.dumps(json.loads(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        return hashlib.sha256(whole.encode()).hexdigest()

    return values.map(one, na_action="ignore")
