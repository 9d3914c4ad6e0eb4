"""State over runs that crash, and a cache that checks what it holds."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.contracts import ContractError
from corpusloom.sources.cache import cache_or_fetch
from corpusloom.streaming import state as S

OUTCOME = "key string, ok boolean, value string, error string, seq bigint"


def rows_of(state):
    return {r["key"]: (r["done"], r["value"], r["error"], r["tries"]) for r in state.read().collect()}


def test_outcomes_of_keys(spark, tmp_path):
    state = S.KeyedState(spark, str(tmp_path / "state"))
    assert rows_of(state) == {}
    first = [("a", False, None, "429", 1), ("b", True, "B1", None, 2), ("c", False, None, "404", 3), ("c", False, None, "500", 4), (None, True, "x", None, 5), ("d", None, "v", "null", 6)]
    assert state.upsert(spark.createDataFrame(first, OUTCOME), 0)
    assert rows_of(state) == {"a": (False, None, "429", 1), "b": (True, "B1", None, 1), "c": (False, None, "500", 2), "d": (False, None, "null", 1)}
    assert not state.upsert(spark.createDataFrame([("a", True, "twice", None, 1)], OUTCOME), 0)  # the batch is run again
    second = [("a", True, "A", None, 1), ("b", False, None, "late", 2)]
    assert state.upsert(spark.createDataFrame(second, OUTCOME), 1)
    after = {"a": (True, "A", None, 2), "b": (True, "B1", None, 2), "c": (False, None, "500", 2), "d": (False, None, "null", 1)}
    assert rows_of(state) == after  # a success clears a failure, a failure doesn't undo a success
    state.compact()
    assert rows_of(state) == after and state.versions.since_base() == 0
    keys = spark.createDataFrame([(k,) for k in "abcd"], "key string")
    assert tuple(state.progress(keys).first()) == (4, 2, 2, False)
    state.upsert(spark.createDataFrame([("c", True, "C", None, 1), ("d", True, "D", None, 1)], OUTCOME), 2)
    assert tuple(state.progress(keys).first()) == (4, 4, 0, True)
    assert tuple(state.progress(keys.union(spark.createDataFrame([("new",)], "key string"))).first()) == (5, 4, 0, False)


def test_values_are_reused_unless_overwritten(spark, tmp_path):
    state = S.KeyedState(spark, str(tmp_path / "state"))
    state.upsert(spark.createDataFrame([("a", True, "old", None, 1), ("b", False, None, "bad", 1)], OUTCOME), 0)
    work = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "key string, text string")

    def extract(rows):
        return S.outcomes(rows, "key", F.col("text").isNotNull(), F.upper("text"), F.lit("no text"), F.lit(1))

    found = {r["key"]: (r["value"], r["reused"]) for r in state.reuse(work, extract).collect()}
    assert found == {"a": ("old", True), "b": ("Y", False), "c": (None, False)}
    found = {r["key"]: (r["value"], r["reused"]) for r in state.reuse(work, extract, overwrite=True).collect()}
    assert found == {"a": ("X", False), "b": ("Y", False), "c": (None, False)}


def test_many_versions_are_folded(spark, tmp_path):
    state = S.KeyedState(spark, str(tmp_path / "state"), versions_at_most=2)
    for k in range(5):
        state.upsert(spark.createDataFrame([(f"k{k}", True, str(k), None, k)], OUTCOME), k)
    assert state.versions.since_base() <= 2 and rows_of(state) == {f"k{k}": (True, str(k), None, 1) for k in range(5)}


@pytest.mark.parametrize("moment", ["before the commit", "after the commit"])
def test_a_crash_between_batches(spark, tmp_path, monkeypatch, moment):
    """Three files, one a batch; the second batch breaks once and the stream is started again."""
    schema = "id bigint, fine boolean"
    for k in range(3):
        spark.createDataFrame([(k * 10 + j, j != k) for j in range(4)] + [(99, k == 2)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    process = lambda rows: S.outcomes(rows.withColumn("key", F.col("id").cast("string")), "key", F.col("fine"), F.lit("v"), F.lit("e"), F.col("id"))
    state = S.KeyedState(spark, str(tmp_path / "state"))
    plain, broken = S.Versions.commit, []

    def breaks(self, step, *rest):
        if step.endswith("/1") and not broken:
            broken.append(step)
            if moment == "after the commit":
                plain(self, step, *rest)
            raise OSError("lost")
        plain(self, step, *rest)

    monkeypatch.setattr(S.Versions, "commit", breaks)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="lost"):
        S.run(stream(), state, process, str(tmp_path / "checkpoint"), "w")
    half = rows_of(state)
    S.run(stream(), state, process, str(tmp_path / "checkpoint"), "w")
    S.run(stream(), state, process, str(tmp_path / "checkpoint"), "w")  # nothing new
    done = rows_of(state)
    assert broken and len(half) < len(done) == 13
    assert {k: v[0] for k, v in done.items()} == {str(k * 10 + j): j != k for k in range(3) for j in range(4)} | {"99": True}
    assert done["99"] == (True, "v", None, 3) and all(v[3] == 1 for k, v in done.items() if k != "99")


def test_cache(spark, tmp_path):
    sha = lambda x: hashlib.sha256(x).hexdigest()
    fetched = []
    delivered = {("a", "1"): b"A1", ("b", "1"): b"B1", ("a", "2"): b"A2"}

    def fetch(rows):
        asked = [(r["id"], r["revision"]) for r in rows.collect()]
        fetched.extend(asked)
        return spark.createDataFrame([(*x, None, delivered[x]) for x in asked if x in delivered], "id string, revision string, sha256 string, content binary")

    def get(*wanted):
        table = spark.createDataFrame(wanted, "id string, revision string, sha256 string")
        return sorted((r["id"], r["revision"], bytes(r["content"]), r["cached"]) for r in cache_or_fetch(spark, table, str(tmp_path / "cache"), fetch).collect())

    assert get(("a", "1", None), ("b", "1", sha(b"B1"))) == [("a", "1", b"A1", False), ("b", "1", b"B1", False)]
    assert get(("a", "1", sha(b"A1")), ("b", "1", None)) == [("a", "1", b"A1", True), ("b", "1", b"B1", True)]
    assert sorted(fetched) == [("a", "1"), ("b", "1")]
    assert get(("a", "2", None), ("b", "1", None)) == [("a", "2", b"A2", False), ("b", "1", b"B1", True)]  # another revision
    for wanted, error in [(("c", "1", None), "not delivered: c"), (("a", "1", "0" * 64), "another digest: a"), ((None, "1", None), "without id")]:
        with pytest.raises(ContractError, match=error):
            get(wanted)
    delivered["d", "1"] = b"other"
    with pytest.raises(ContractError, match="another digest: d"):
        get(("d", "1", sha(b"D1")))
    delivered["d", "1"] = b"D1"
    assert get(("d", "1", sha(b"D1"))) == [("d", "1", b"D1", False)]  # the refused one was never committed


def test_a_corrupt_entry_is_found(spark, tmp_path):
    from corpusloom.sources import cache

    versions = S.Versions(spark, str(tmp_path / "cache"), cache.SCHEMA)
    versions.write(spark.createDataFrame([("a", "1", hashlib.sha256(b"A").hexdigest(), b"changed")], cache.SCHEMA), "s")
    with pytest.raises(ContractError, match="corrupt in the cache: a"):
        cache.cache_or_fetch(spark, spark.createDataFrame([("a", "1", None)], "id string, revision string, sha256 string"), str(tmp_path / "cache"), None)
