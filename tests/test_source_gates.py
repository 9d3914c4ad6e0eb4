"""Each gate of each kind of source is hit once, in its order; providers of languages."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import source_gates as G

SCHEMA = "name string, slug string, title string, authors array<string>, text string, math_failed int, math_unbalanced boolean, license_on_page boolean, license_in_source boolean, rights_conflict boolean, page_failures int, language string, confidence double"
GOOD = {"name": "good", "slug": "s", "title": "t", "authors": ["A"], "text": "słowo " * 1000, "math_failed": 0, "math_unbalanced": False, "license_on_page": True, "license_in_source": True, "rights_conflict": False, "page_failures": 0, "language": "pl", "confidence": 1.0}
LONG = "słowo " * 1000
CASES = {
    "textbook": [
        ({"slug": "przedmowa", "math_failed": 1}, "frontmatter_index_bibliography_or_answer_key"), ({"slug": "rozdzial-7"}, "frontmatter_index_bibliography_or_answer_key"), ({"slug": "rozdzial-7-x"}, None),
        ({"math_failed": 2, "text": ""}, "unconverted_math"), ({"text": "1 "}, "too_short"), ({"text": None}, "too_short"), ({"text": "1 2 " * 99}, "low_letter_ratio"),
        ({"language": "cs", "confidence": 0.99}, "high_confidence_non_polish"), ({"language": "cs", "confidence": 0.98}, None), ({"language": None, "confidence": None}, None),
    ],
    "chemistry": [
        ({"title": "Spis treści"}, "frontmatter_or_bibliography"), ({"text": "x"}, "too_short"), ({"math_unbalanced": True}, "unbalanced_math"), ({"text": "1 2 " * 99}, "low_letter_ratio"),
        ({"language": "en"}, "non_polish"), ({"authors": [], "text": "x"}, "missing_authorship"), ({"authors": None}, "missing_authorship"),
    ],
    "lesson": [
        ({"license_on_page": False, "authors": []}, "license_not_explicit_on_page_and_xml"), ({"license_in_source": None}, "license_not_explicit_on_page_and_xml"), ({"authors": [], "text": ""}, "missing_creator"),
        ({"text": "x" * 299}, "too_short"), ({"language": "en"}, "non_polish"),
    ],
    "guide": [
        ({"rights_conflict": True, "page_failures": 1}, "rights_or_authorship_conflict"), ({"page_failures": 1, "text": "�"}, "page_extraction_failure"), ({"text": LONG + "\x81"}, "text_extraction_garbled"),
        ({"text": LONG + "e\u0301"}, "text_extraction_split_diacritics"), ({"text": LONG + "mied byd " * 6}, "text_extraction_legacy_font_mapping"), ({"text": "x" * 999}, "too_little_extractable_text"),
        ({"text": "1 2 3" * 400}, "low_letter_ratio"), ({"language": "en", "confidence": 0.98}, "non_polish"), ({"language": "en", "confidence": 0.97}, None),
    ],
    "academic": [
        ({"text": "x" * 4999}, "too_little_extractable_text"), ({"text": "1" * 6000}, "low_letter_ratio"), ({"text": LONG + "�"}, "excessive_unreadable_glyphs"), ({"text": "a" * 600_000 + "�" * 5}, None),
        ({"text": "a" * 900_000 + "�" * 6}, "excessive_unreadable_glyphs"), ({"language": "en", "confidence": 0.95}, "non_polish"),
    ],
    "notice": [
        ({"text": "�", "authors": []}, "replacement_character"), ({"authors": [], "text": "x"}, "missing_contracting_authority"), ({"text": "x" * 299}, "too_short_after_cleaning"), ({"language": "en", "confidence": 0.98}, "non_polish"),
    ],
}


@pytest.mark.parametrize("kind", list(CASES))
def test_every_gate(spark, kind):
    rows = [{**GOOD}] + [{**GOOD, **change, "name": str(k)} for k, (change, _) in enumerate(CASES[kind])]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    table = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)
    found = {r["name"]: r["reasons"][0]["reason"] for r in G.judged(table, [kind], G.Given()).collect()}
    assert found == {"good": None} | {str(k): reason for k, (_, reason) in enumerate(CASES[kind])}
    assert set(found.values()) - {None} == {g.reason for g in G.SOURCES[kind](F.lit(""), "pl")}


def test_a_trained_provider(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = G.Trigrams.train(docs.where("doc_id % 2 = 0"))
    found = docs.where("doc_id % 2 = 1").select("lang", "text", model.of(F.col("text")).alias("said")).where("length(text) > 200").toPandas()
    assert (found.lang == found.said.map(lambda x: x["language"])).mean() > 0.97 and len(found) > 200
    assert model.classify(None) == model.classify("12 34") == ("unknown", 0.0)
    table = spark.createDataFrame([("en" * 400, ["A"], "x")], "text string, authors array<string>, said string")
    assert G.judged(table, ["notice"], model, "en").columns == ["text", "authors", "reasons"]
    empty = G.Trigrams.train(docs.where("false"))
    assert empty.classify("some text") == ("unknown", 0.0)


def test_texts_are_judged_once(spark):
    from corpusloom.operators.evidence_queries import source_gate_reasons

    plan = source_gate_reasons(spark, "/root/testdata/sf0.01")._jdf.queryExecution().optimizedPlan().toString()
    # eleven words, unreadable glyphs as a number and as a share, and a count of letters for each of two alphabets
    assert plan.count("regexp_extract_all") == 15 and plan.count("lower(") == 1


def test_one_glyph_in_a_long_text_counts_as_in_the_sql(spark, tmp_path):
    from corpusloom.operators.evidence_queries import ORACLES, source_gate_reasons

    texts = [(29, "word " * n, lang) for n, lang in ((19_000, "en"), (19_999, "en"), (20_000, "en"), (24_000, "en"), (24_000, "es"), (24_000, None))] + [(30, "word " * 24_000, "en"), (58, None, "en")]
    spark.createDataFrame(texts, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    documents = duckdb.read_parquet(f"{tmp_path}/documents.parquet/*.parquet")  # noqa: F841 (named in the SQL)
    found = Counter(tuple(r) for r in source_gate_reasons(spark, str(tmp_path)).collect())
    assert found == Counter(duckdb.sql(ORACLES["source_gate_reasons"]).fetchall())
    assert ("academic", "excessive_unreadable_glyphs", 6) in found
