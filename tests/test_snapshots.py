"""Only the folders and files that are asked for are listed and read."""

import hashlib
import re

from corpusloom.sources import snapshots as S

PATTERNS = ["*.csv", "manifest.jsonl", "report-?.json"]


def made(tmp_path):
    for batch in ("b1", "b2", "b 3{x}", "other"):
        (tmp_path / batch / "deep").mkdir(parents=True)
        for name in ("a.csv", "manifest.jsonl", "report-1.json", "report-10.json", "raw.pdf", "deep/c.csv"):
            (tmp_path / batch / name).write_text(f"{batch}/{name}")
    return str(tmp_path)


def test_files_of_batches(spark, tmp_path):
    root = made(tmp_path)
    rows = S.pull(spark, root, ["b1", "b 3{x}", "none", "b1"], PATTERNS).collect()
    names = [n for n in ("a.csv", "manifest.jsonl", "report-1.json", "report-10.json", "raw.pdf") if S.matches(n, PATTERNS)]
    assert len(names) == 3
    found = sorted((r["batch"].replace("%20", " ").replace("%7B", "{").replace("%7D", "}"), r["name"], bytes(r["content"]).decode(), r["sha256"]) for r in rows)
    assert found == sorted((b, n, f"{b}/{n}", hashlib.sha256(f"{b}/{n}".encode()).hexdigest()) for b in ("b1", "b 3{x}") for n in names)
    assert S.pull(spark, root, [], PATTERNS).count() == S.pull(spark, root, ["none"], PATTERNS).count() == S.pull(spark, root, ["b1"], []).count() == 0


def test_partitions_are_pruned(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(40).selectExpr("id", "2020 + id % 4 AS year", "IF(id % 2 = 0, 'a', 'b') AS kind").repartition(1).write.partitionBy("year", "kind").parquet(root)
    rows = S.partitions(spark, root, "id bigint, year int, kind string", year=[2020, 2022], kind=["a"])
    assert sorted(r["id"] for r in rows.collect()) == [k for k in range(40) if k % 4 in (0, 2)]
    scan = next(x for x in re.split("\n", rows._jdf.queryExecution().explainString(rows._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))) if "PartitionFilters" in x)
    assert "year" in scan and "kind" in scan
    only = S.partitions(spark, root, "id bigint, year int, kind string", year=[2021])
    assert len(only.inputFiles()) >= 1 and sorted({r["year"] for r in only.collect()}) == [2021]
    metrics = only._jdf.queryExecution().executedPlan()
    only.count()
    assert S.partitions(spark, root, "id bigint, year int, kind string", year=[]).count() == 0 and metrics is not None
