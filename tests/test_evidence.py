"""Every rule is broken once, and reported with its examples; replays that differ."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import evidence as V

MANIFEST = [("q1", "o1", "u1", "d1", 10), ("q2", "o2", "u2", "d2", 20)]
ANNOTATIONS = [("q1", "u1", "d1", "downloaded", "ann", "good"), ("q2", "u2", "d2", "downloaded", "", "poor")]
FILES = [("q1", "d1", 10), ("q2", "d2", 20)]


def lines(report):
    return {r["check"]: (r["severity"], r["violations"], r["examples"]) for r in report.collect() if r["violations"]}


def manifest(spark, m=MANIFEST, a=ANNOTATIONS, f=FILES, waived=()):
    tables = {
        "manifest": spark.createDataFrame(m, "queue_id string, object_id string, url string, sha256 string, bytes bigint"),
        "annotations": spark.createDataFrame(a, "queue_id string, document_url string, artifact_sha256 string, fetch_status string, reviewer string, quality string"),
        "files": spark.createDataFrame(f, "queue_id string, sha256 string, bytes bigint"),
    }
    return V.report(tables, V.manifest_rules(2, {"quality": ["good", "poor"]}), waived)


def test_manifest(spark):
    fine = manifest(spark)
    assert lines(fine) == {} and V.passed(fine) and fine.columns == V.REPORT and fine.count() == 16
    one = MANIFEST[0]
    broken = manifest(spark, [one, one, ("q3", "o3", "u3", "d3", None)], [*ANNOTATIONS, ("q1", "other", "d9", "failed", None, "odd"), ("q3", "u3", "d3", None, " ", None)], [("q1", "d1", 11), ("q3", "x", 1)])
    found = lines(broken)
    assert {k: v[1:] for k, v in found.items()} == {
        "manifest rows": (1, ["3"]), "annotation rows": (1, ["4"]), "queue_id is unique": (1, ["q1"]), "object id is unique": (1, ["o1"]), "source URL is unique": (1, ["u1"]),
        "artifact digest is unique": (1, ["d1"]), "artifact has its digest": (1, ["q3"]), "artifact has its size": (2, ["q1", "q3"]), "annotation has the digest": (1, ["q1"]),
        "annotation has the URL": (1, ["q1"]), "annotated digest is in the manifest": (2, ["d2", "d9"]), "quality is controlled": (2, ["q1"]), "file was downloaded": (2, ["q1"]),
    }
    assert not V.passed(broken) and all(v[0] == "error" for v in found.values())
    found = lines(manifest(spark, [("q9", "o", "u", "d", 1)], [(*ANNOTATIONS[0][:4], "", "good")], []))
    assert {"artifact is there", "manifest row is annotated"} <= set(found) and found["no review is completed"][0] == "warning"


def test_a_waived_rule_warns(spark):
    same = [MANIFEST[0], (*MANIFEST[1][:3], "d1", 20)]
    args = (same, [ANNOTATIONS[0], ("q2", "u2", "d1", "downloaded", "", "good")], [FILES[0], ("q2", "d1", 20)])
    assert not V.passed(manifest(spark, *args))
    waived = manifest(spark, *args, waived=["artifact digest is unique"])
    assert V.passed(waived) and lines(waived) == {"artifact digest is unique": ("warning", 1, ["d1"])}


def test_extraction(spark):
    def run(s, e, t, o):
        tables = {
            "sources": spark.createDataFrame(s, "object_id string"), "extractions": spark.createDataFrame(e, "queue_id string, source_object_id string, sha256 string, bytes bigint, path string"),
            "texts": spark.createDataFrame(t, "queue_id string, sha256 string, bytes bigint"),
            "observations": spark.createDataFrame(o, "queue_id string, text_sha256 string, text_path string, extract_status string, machine_extraction_quality_hint string, machine_pii_hint string"),
        }
        return lines(V.report(tables, V.extraction_rules(1, {"extract_status": ["extracted", "empty_text"]})))

    assert run([("o1",)], [("q1", "o1", "d", 3, "p")], [("q1", "d", 3)], [("q1", "d", "p", "extracted", "good", "no")]) == {}
    found = run(
        [("o1",), ("o2",)], [("q1", "o1", "d", 3, "p"), ("q2", "o9", "e", 1, "r"), ("q3", "o1", "f", 1, "s")], [("q1", "x", 4), ("q3", "f", 1)],
        [("q1", "y", "z", "empty_text", "poor", "yes"), ("q1", "d", "p", "broken", "good", "no"), ("q2", "e", "r", "extracted", None, "no")],
    )
    assert {k: v[2] for k, v in found.items()} == {
        "sources rows": ["2"], "extractions rows": ["3"], "observations rows": ["3"], "extracted object is a source": ["o9"], "source is extracted": ["o2"], "observation is unique": ["q1"],
        "text is there": ["q2"], "text has its digest": ["q1"], "text has its size": ["q1"], "extraction is observed": ["q3"], "observation has the digest": ["q1"], "observation has the path": ["q1"],
        "extract_status is controlled": ["q1"], "text isn't empty": ["q1"], "quality suffices": ["q1"], "no personal data is hinted at": ["q1"],
    }
    assert {k for k, v in found.items() if v[0] == "warning"} == {"text isn't empty", "quality suffices", "no personal data is hinted at"}


def test_dataset(spark):
    def run(rows, attribution, decisions, sample):
        tables = {
            "rows": spark.createDataFrame(rows, "id string, text string, token_count bigint, license string, author string"), "attribution": spark.createDataFrame(attribution, "id string"),
            "decisions": spark.createDataFrame(decisions, "id string, selected boolean"), "sample": spark.createDataFrame(sample, "id string, text string"),
        }
        return {k: v[2] for k, v in lines(V.report(tables, V.dataset_rules(2, 3, 7, "CC"))).items()}

    good = [("a", "x", 3, "CC", "A"), ("b", "y", 4, "CC", "B")]
    decisions = [("a", True), ("b", True), ("c", False)]
    assert run(good, [("a",), ("b",)], decisions, [("a", "x"), ("b", "y")]) == {}
    assert run([good[0], good[0], ("z", "mail a@b.pl �", 1, "NC", None)], [("a",), ("a",), ("n",)], [("a", True), ("b", None)], [("a", "changed"), ("s", "")]) == {
        "kept rows": ["3"], "attributed rows": ["3"], "decisions": ["2"], "selected decisions": ["1"], "id is unique": ["a"], "attribution is unique": ["a"], "row is attributed": ["z"], "attribution has a row": ["n"],
        "row was selected": ["z"], "author is named": ["z"], "license is the set's": ["z"], "no replacement characters": ["z"], "no e-mail address": ["z"], "sampled row is there": ["s"], "sampled row is the same": ["a"],
    } | {}  # tokens are 7 here too
    assert set(run([], [], [], [])) == {"kept rows", "attributed rows", "decisions", "selected decisions", "tokens", "sampled rows"}


def test_lineage(spark):
    def run(claims, evidence, runs, relations):
        tables = {
            "claims": spark.createDataFrame(claims, "id string, supported_by array<string>, falsification_condition string"), "evidence": spark.createDataFrame(evidence, "id string"),
            "runs": spark.createDataFrame(runs, "id string, success boolean"), "relations": spark.createDataFrame(relations, "source string, predicate string, target string"),
        }
        return {k: v[2] for k, v in lines(V.report(tables, V.lineage_rules(["derived_from"]))).items()}

    assert run([("c", ["e1"], "if x")], [("e1",)], [("r1", True), ("r2", True)], [("a", "derived_from", "b")]) == {}
    assert run([("c", ["e1", "e9"], " "), ("d", [], "y")], [("e1",), ("e1",)], [("r1", True), ("r2", None)], []) == {
        "claim can be falsified": ["c"], "support is evidence": ["e9"], "claim is supported": ["d"], "evidence is unique": ["e1"], "two runs or more": ["0"], "run succeeded": ["r2"], "a relation derived_from": ["0"],
    }


def test_one_scan_for_all_rules_of_a_table(spark):
    rows = spark.range(50).withColumn("x", F.col("id") * 2)
    rules = [V.Holds(f"h{k}", "t", F.col("x") > k, "id") for k in range(6)] + [V.Total("n", "t", F.count(F.lit(1)), 50)]
    plan = V.report({"t": rows}, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
    with pytest.raises(ValueError):
        V.report({"t": rows}, [rules[0], rules[0]])


def test_replay(spark):
    snapshot = spark.createDataFrame([(1, "One  two", "x"), (2, None, "x"), (3, "three", "x"), (4, "four", "x")], "id int, raw string, extra string")
    made = V.Transform("collapse", "2", lambda rows: rows.select("id", F.regexp_replace("raw", " +", " ").alias("text"), F.length("raw").alias("n")))
    recorded = spark.createDataFrame([(1, "One two", 8, "2"), (2, None, None, "2"), (3, "THREE", 6, "2"), (4, "four", 4, "1"), (9, "gone", 4, "2")], "id int, text string, n int, made_by string")
    found = {r["id"]: (r["problem"], r["columns"]) for r in V.replayed(snapshot, recorded, "id", made, F.col("made_by")).collect()}
    assert found == {3: ("differs", ["text", "n"]), 4: ("other version", []), 9: ("not replayed", [])}
    assert {r["id"]: r["problem"] for r in V.replayed(snapshot, recorded.where("id < 3"), "id", made).collect()} == {3: "not recorded", 4: "not recorded"}
    with pytest.raises(ValueError, match="not recorded: n"):
        V.replayed(snapshot, recorded.drop("n"), "id", made)
