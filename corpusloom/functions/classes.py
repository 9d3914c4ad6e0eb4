"""Classes of documents and files by their names and first bytes, and what a legal review is asked."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.repair import path_suffix

#: Code points of a text that are looked into.
HEAD = 4000
# Media types of office files by suffix.
OFFICE = {
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
}


def document_type(filename: Column, category: Column, text: Column) -> Column:
    """What a document of a consultation is, by its name and category first and its text last. Nulls count as empty."""
    empty = F.lit("")
    name = F.lower(F.concat_ws("\n", F.coalesce(filename, empty), F.coalesce(category, empty)))
    whole = F.lower(F.concat_ws("\n", name, F.left(F.coalesce(text, empty), F.lit(HEAD))))
    has = lambda where, *words: F.exists(F.array(*map(F.lit, words)), lambda word: F.contains(where, word))
    return (
        F.when(has(name, "stanowisk"), "organization_comment")
        .when(has(name, "odniesienie") & has(name, "uwag"), "government_response")
        .when(has(name, "pismo kierujące", "pismo kierujace"), "cover_letter")
        .when(has(name, "projekt") & has(name, "ustawy", "rozporządzenia"), "draft_law")
        .when(has(whole, "stanowisk", "uwag", "opinia"), "organization_comment")
        .otherwise("other")
    )


def media_type(content: Column, reported: Column, url: Column) -> Column:
    """Struct of media_type and suffix of a file: by its first bytes, then by its address, then as reported (null or empty: not)."""
    told = F.when(reported != "", reported)
    suffix = F.lower(path_suffix(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)))
    office = F.element_at(F.create_map(*(F.lit(x) for pair in OFFICE.items() for x in pair)), suffix)
    begins = lambda mark: F.hex(F.substring(content, 1, len(mark))) == mark.hex().upper()
    made = lambda kind, end: F.struct(kind.alias("media_type"), end.alias("suffix"))
    archive = made(F.coalesce(office, told, F.lit("application/zip")), F.when(suffix != "", suffix).otherwise(".zip"))
    other = made(F.coalesce(told, F.lit("application/octet-stream")), F.when(F.length(suffix).between(2, 9), suffix).otherwise(".bin"))
    return F.when(begins(b"%PDF-"), made(F.lit("application/pdf"), F.lit(".pdf"))).when(begins(b"PK\x03\x04"), archive).otherwise(other)


def legal_priority(recommendation: Column, contains_pii: Column) -> Column:
    return F.when(recommendation == "exclude", "3_exclusion_confirmation").when(contains_pii.isin("yes", "uncertain"), "1_training_candidate_with_pii").otherwise("2_training_candidate_low_pii")


def legal_question(recommendation: Column, contains_pii: Column, question: str, exclusion: str, personal: str) -> Column:
    """``exclusion`` for rows that are to be excluded, else ``question``, with ``personal`` behind it where there may be personal data."""
    return F.when(recommendation == "exclude", exclusion).when(contains_pii.isin("yes", "uncertain"), f"{question} {personal}").otherwise(question)
