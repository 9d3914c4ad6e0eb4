"""Column builders for normalisation, measures, redaction and classification of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of what the gates look for, in Java's dialect.
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
HTML_TAG = r"<[^>]{1,120}>"
URL = r"(?i)\b(https?://|www\.)\S+"
EMAIL = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
NATIONAL_NUMBER = r"(?<!\d)\d{11}(?!\d)"
PHONE = r"(?<!\d)(?:\+?48[ .-]?)?(?:\d[ .-]?){9}(?!\d)"
#: Fixed value: what redaction masks as a phone number, a labelled or grouped one. The detector above is wider.
MASKED_PHONE = r"(?i)(?<![\p{L}\p{N}_])(?:(?:tel(?:efon)?\.?\s*:?\s*|\+48[ .-]?)\d{3}[ .-]?\d{3}[ .-]?\d{3}|\d{3}[ .-]\d{3}[ .-]\d{3})(?!\d)"
#: Fixed value: phone numbers as tags, with any blank between digits.
TAGGED_PHONE = r"(?<![0-9])(?:\+?48[\s\u00A0.-]?)?(?:[0-9][\s\u00A0.-]?){9}(?![0-9])"
REPEATED = r"(?i)(.)\1{7,}"
LABELLED_ID = r"(?i)\b(?:PESEL|NIP|REGON)\s*:?[ \t]*(?:\d[ -]?){9,14}\b"
ADDRESS = r"(?iu)\b(?:ul\.|ulica|al\.|aleja|pl\.|plac)\s+[A-ZĄĆĘŁŃÓŚŹŻ][^\n,;]{2,80}\s+\d"
SIGNATURE = r"(?iu)\b(?:podpis|podpisano|z poważaniem|z powazaniem|prezes|członek zarządu|czlonek zarzadu|dyrektor)\b"
TOKEN = r"[\p{L}\p{N}_]+"


def collapsed(text: Column) -> Column:
    """Runs of blanks as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def cleaned_lines(text: Column) -> Column:
    """Control characters and invisible hyphens out; each line collapsed; at most one empty line in a row."""
    plain = F.regexp_replace(F.regexp_replace(text, CONTROL, ""), "[­​]", "")
    lines = F.transform(F.split(plain, r"\r\n|[\n\r\u0085  ]"), lambda x: F.trim(F.regexp_replace(x, "[ \t ]+", " ")))
    return F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def text_key(text: Column) -> Column:
    """The form in which texts are compared: lower case, collapsed."""
    return collapsed(F.lower(text))


def sentence_key(text: Column) -> Column:
    """As ``text_key`` with punctuation as blanks."""
    return collapsed(F.regexp_replace(F.lower(text), r"\p{P}", " "))


def letters(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\p{L}"))


def letter_ratio(text: Column) -> Column:
    return letters(text) / F.greatest(F.lit(1), F.length(text))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def token_proxy(text: Column) -> Column:
    """Estimated subword tokens: the larger of characters / 3.5 and words x 1.5, halves to even."""
    return F.bround(F.greatest(F.length(text) / F.lit(3.5), word_count(text) * F.lit(1.5))).cast("bigint")


def redacted(text: Column) -> Column:
    """E-mail addresses, labelled national ids and phone numbers masked, in this order."""
    text = F.regexp_replace(text, EMAIL, "[PII]")
    text = F.regexp_replace(text, LABELLED_ID, "[PII]")
    return F.regexp_replace(text, MASKED_PHONE, "[Telefon]")


def redaction_counts(text: Column) -> dict[str, Column]:
    """Matches of each kind, counted as ``redacted`` meets them."""
    no_mail = F.regexp_replace(text, EMAIL, "[PII]")
    no_id = F.regexp_replace(no_mail, LABELLED_ID, "[PII]")
    return {
        "email": F.regexp_count(text, F.lit(EMAIL)),
        "national_id": F.regexp_count(no_mail, F.lit(LABELLED_ID)),
        "phone": F.regexp_count(no_id, F.lit(MASKED_PHONE)),
    }


def pii_tags(text: Column) -> Column:
    """Kinds of personal data found, joined by semicolons."""
    kinds = (("email", EMAIL), ("phone", TAGGED_PHONE), ("personal_identifier", NATIONAL_NUMBER), ("address", ADDRESS), ("signature_or_named_role", SIGNATURE))
    return F.concat_ws(";", *(F.when(text.rlike(pattern), F.lit(name)) for name, pattern in kinds))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0)


def shingles(words: Column, width: int = 5) -> Column:
    """The distinct runs of ``width`` words; none for a shorter text."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.array_join(F.slice(words, i, width), " "))
    return F.when(F.size(words) >= width, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def quality_hint(chars: Column, words: Column, pages: Column, status: Column) -> Column:
    # Bounds of characters, words and characters a page.
    return (
        F.when((status != "extracted") | (chars == 0), "not_extractable")
        .when((chars < 500) | (words < 80), "poor")
        .when((pages > 0) & (chars / pages < 350), "poor")
        .when(chars < 1500, "usable")
        .otherwise("good")
    )


def review_priority(pii: Column, quality: Column, kind: Column) -> Column:
    return (
        F.when(pii == "yes", "pii_first")
        .when(quality.isin("poor", "not_extractable"), "extraction_first")
        .when(kind != "organization_comment", "scope_check")
        .otherwise("standard")
    )


def content_id(source: Column, key: Column) -> Column:
    return F.concat(source, F.lit("_"), F.sha2(key, 256))
