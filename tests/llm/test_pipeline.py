import inspect

import corpus_pipeline
from pyspark.sql import functions as F

from corpusloom.llm import languages
from corpusloom.llm.runtime import documents

from . import cases
from .test_dedup import brute_links, brute_runs
from .test_models import check_mix
from corpusloom.llm.units import without

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = documents(spark, SMALL).limit(120)
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = [tuple(r) for r in docs.collect()]
        if k < 4:
            assert docs.columns == columns
        if k == 0:
            assert len(before) - len(after) <= 3 and set(after) <= set(before)
        elif k == 1:
            gone = brute_runs(before)
            expected = {}
            for r in before:
                text = without(r[1], gone[r[0]])[0] if gone.get(r[0]) else r[1]
                if text.strip():
                    expected[r[0]] = text
            assert {r[0]: r[1] for r in after} == expected and all(r[4] == len(r[1]) for r in after)
        elif k == 2:
            assert sorted(r[0] for r in after) == sorted({c for _, c, _ in brute_links(before)})
        elif k == 3:
            assert {r[0] for r in after} <= {r[0] for r in before} and len(after) > 0
        else:
            assert docs.columns == ["doc_id", "ids"] and len(after) == len(before)


def test_odd_documents_pass_all_stages(spark, tmp_path):
    docs = cases.table(spark).drop("digest", "rank")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert docs.count() > 0
    none = cases.empty(spark).drop("digest", "rank")
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SMALL)
    assert none.count() == 0


def test_rejected_languages(spark):
    docs = cases.table(spark)
    kept = languages.keep_identified(docs)
    assert kept.where("text is null and doc_id is not null or text = ''").count() == 0
    assert kept.columns == docs.columns


def test_shape():
    assert corpus_pipeline.ORACLE_SQL is None
    assert all(len(inspect.signature(f).parameters) == 3 for _, f in corpus_pipeline.STAGES)
    assert check_mix


def test_a_worker_lets_go_what_other_operators_left(spark):
    """A codec stays in a worker over its operator's tasks only."""
    from corpusloom.llm import byte_pairs, pieces
    from corpusloom.llm.runtime import tidy

    docs = spark.createDataFrame([(k, "some text here") for k in range(4)], "doc_id bigint, text string").coalesce(1)

    def held(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(pieces.codec.__globals__["_codecs"]), len(byte_pairs.codec.__globals__["_codecs"])]})

    def left(keeps):
        pieces.digests(docs, pieces.model_file()).collect()
        return [r["n"] for r in docs.mapInArrow(tidy(held, keeps), "n bigint").collect()]

    assert left("")[0] == 0 and left("byte_pairs")[0] == 0


def test_a_worker_gives_back_what_others_left_before_it_begins(monkeypatch):
    from corpusloom.llm import runtime

    seen = []
    monkeypatch.setattr(runtime, "let_go", lambda keeps: seen.append(keeps))
    monkeypatch.setattr(runtime, "give_back", lambda: seen.append("back"))
    assert list(runtime.tidy(lambda batches: (seen.append("run") or x for x in batches), "own")(iter([1]))) == [1]
    assert seen == ["own", "back", "run", "back"]


def test_numbering_starts_no_python_workers(spark, monkeypatch):
    """Workers of an RDD of Python objects would stay in each executor beside those of the operators."""
    from corpusloom.llm.runtime import dense_ids

    def parallelize(*_):
        raise AssertionError("a table went through Python workers")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", parallelize)
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    assert sorted((r["x"], r["n"]) for r in dense_ids(rows, F.col("x"), name="n").collect()) == [(k, k) for k in range(1000)]
    assert dense_ids(rows.limit(0), F.col("x"), name="n").collect() == []
