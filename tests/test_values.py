"""Values that no SQL looks at: fixed strings, brute force, and graphs with cycles."""

import difflib

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators.gates import exact_keep_first
from corpusloom.operators.near import greedy_removed
from corpusloom.operators.review_queries import ancestors, fuzzy_top3
from corpusloom.streaming.incremental import remaining, resume


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column).first()[0]


def test_redaction(spark):
    mixed = "Kontakt: anna@example.pl, tel. +48 123 456 789, NIP 123-456-32-18"
    masked = one(spark, mixed, X.redacted(F.col("t")))
    assert "anna@example.pl" not in masked and "123 456 789" not in masked and "123-456-32-18" not in masked
    assert [one(spark, mixed, c) for c in X.redaction_counts(F.col("t")).values()] == [1, 1, 1]
    code = "Kod CPV 33141320-9, telefon 123456789."
    assert one(spark, code, X.redacted(F.col("t"))) == "Kod CPV 33141320-9, [Telefon]."
    assert one(spark, code, X.redaction_counts(F.col("t"))["phone"]) == 1


def test_null_keys_keep_their_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "a")], "id bigint, text string")
    assert {r["id"]: r["duplicate_of"] for r in exact_keep_first(rows, F.col("text"), "id").collect()} == {1: None, 2: None, 3: 1, 4: 2}


def test_ancestors_of_a_long_chain_and_a_cycle(spark):
    edges = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(30)] + [("x", "y"), ("y", "x")], "a string, b string")
    found = {r["a"]: (r["ancestors"], r["depth"], r["cyclic"]) for r in ancestors(edges).collect()}
    assert found["n0"] == (30, 30, False) and found["n29"] == (1, 1, False) and found["x"] == found["y"] == (2, 2, True)


def test_fuzzy_titles_match_brute_force(spark):
    titles = ["abcdefghi", "abcdefghixy", "abcdefghiz", "polish grammar", "polish grammars", "polish  grammar", "other", "othe", "abcde", "abcdef"]
    expected = set()
    for a in titles:
        near = sorted(((difflib.SequenceMatcher(None, a, b).ratio(), b) for b in titles if b != a), reverse=True)
        expected |= {(a, b) for s, b in near[:3] if s >= 0.9}
    found = fuzzy_top3(spark.createDataFrame([(t, 1) for t in titles], "title string, n int"))
    assert {(r["title"], r["other"]) for r in found.collect()} == expected and ("abcdefghixy", "abcdefghi") in expected


def test_greedy_chain(spark):
    """A is like B, B like C: B goes, C stays, as the row that it is like has gone."""
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "a string, b string")
    assert {r["id"]: r["duplicate_of"] for r in greedy_removed(pairs).collect()} == {"b": "a", "d": "c"}


def test_each_row_is_processed_once(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "id bigint, v string"

    def add(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        resume(spark, source, spark.createDataFrame([], schema).schema, out, state, lambda rows: rows.withColumn("v", F.upper("v")), files_per_batch=1)
        return sorted((r["id"], r["v"]) for r in spark.read.parquet(out).collect())

    add((1, "a"), (2, "b"))
    assert run() == [(1, "A"), (2, "B")] == run()
    add((3, "c"))
    assert run() == [(1, "A"), (2, "B"), (3, "C")]
    assert [r["id"] for r in remaining(spark.range(5), spark.read.parquet(out), "id").orderBy("id").collect()] == [0, 4]
