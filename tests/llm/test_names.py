"""Columns of any name stay as they are, whatever names the operators use themselves."""

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import chosen_path, languages, line_runs, mixing, substrings

from . import cases

NAMES = "_id _text _own _marks _letters _once _k _each _rows _copies _size _source _given row blank rank first n pos head marks node root a.b c`d".split()


@pytest.mark.parametrize("run", [chosen_path.keep_one, languages.keep_identified, line_runs.dedup_documents, line_runs.dedup_runs, substrings.dedup_passages, mixing.take])
def test_clashing_names(spark, run):
    docs = cases.table(spark).drop("digest", "rank")
    wide = docs.select("*", *(F.concat(F.lit(f"{name}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(name) for name in NAMES))
    done = run(wide)
    assert [c for c in done.columns if c != "removed"] == wide.columns
    for r in done.collect():
        own = r.asDict()
        assert all(own[name] == f"{name}-{'none' if own['doc_id'] is None else own['doc_id']}" for name in NAMES)


def test_texts_of_blank_lines_go(spark):
    """What is left of a text between removed lines may be line feeds alone."""
    line = "five words are in here"
    docs = spark.createDataFrame([(1, line), (2, f"{line}\n\n\n{line}"), (3, " \n "), (4, None)], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in line_runs.dedup_documents(docs).collect()) == [1, 3, 4]


def test_a_column_named_removed(spark):
    line = "five words are in here"
    docs = spark.createDataFrame([(1, line, "x"), (2, line + "\nown", "y")], "doc_id bigint, text string, removed string")
    assert [tuple(r) for r in line_runs.dedup_documents(docs).orderBy("doc_id").collect()] == [(1, line, "x"), (2, "own", "y")]
    assert line_runs.dedup_runs(docs).columns == ["doc_id", "text", "removed"]
