"""Passages that repeat anywhere, against a comparison of all windows."""

import random
from collections import defaultdict

from corpusloom.llm import substrings as passages
from corpusloom.llm.substrings import normal

from . import cases


def brute(rows):
    """The word positions to remove for each doc_id: of all windows that equal an earlier one."""
    seen, gone = {}, defaultdict(set)
    texts = {r[0]: normal(r[1] or "").split() for r in rows if r[0] is not None}
    for doc_id in sorted(texts):
        own = texts[doc_id]
        for p in range(len(own) - passages.PASSAGE + 1):
            key = tuple(own[p : p + passages.PASSAGE])
            if seen.setdefault(key, (doc_id, p)) != (doc_id, p):
                gone[doc_id] |= set(range(p, p + passages.PASSAGE))
    return gone


def kept_words(text, gone):
    return [w for k, w in enumerate(text.split()) if k not in gone]


def check(spark, rows, schema):
    gone = brute(rows)
    done = passages.dedup_passages(spark.createDataFrame(rows, schema).repartition(3)).collect()
    assert gone and len(done) == len(rows)
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    for r in done:
        if r["doc_id"] is not None and texts[r["doc_id"]]:
            old = texts[r["doc_id"]]
            assert (r["text"] or "").split() == kept_words(old, gone.get(r["doc_id"], set()))
            assert (r["removed"] is not None) == bool(gone.get(r["doc_id"]))
            for begin, end in r["removed"] or []:
                assert not old[begin].isspace() and not old[end - 1].isspace()
    return done


def test_all_windows_are_compared(spark):
    check(spark, cases.rows(), cases.SCHEMA)
    rng = random.Random(8)
    hot = cases.prose(rng, 70)
    long = cases.prose(rng, 400)
    rows = [(k, None if k == 3 else "") for k in range(5)]
    for k in range(5, 80):
        a, b = sorted(rng.randrange(400) for _ in range(2))
        parts = [cases.prose(rng, rng.randrange(60)), hot if k % 3 else "", " ".join(long.split()[a:b]), cases.prose(rng, rng.randrange(30))]
        rng.shuffle(parts)
        text = rng.choice([" ", "\n", " \n\n"]).join(parts)
        rows.append((k, text.upper() if k % 7 == 0 else text))
    rows += [(90, "q " * 130), (91, "q w " * 40), (92, cases.prose(rng, 49)), (93, cases.prose(rng, 50)), (94, rows[20][1])]
    check(spark, rows, "doc_id bigint, text string")
    assert passages.dedup_passages(cases.empty(spark)).count() == 0


def test_a_passage_inside_a_line(spark):
    """Its first and last line differ in each document."""
    rng = random.Random(9)
    passage = cases.prose(rng, 60)
    rows = [(1, f"own {passage} start"), (2, f"other\nbegin {passage} end here\nlast")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in passages.dedup_passages(docs).collect()} == {1: rows[0][1], 2: "other\nbegin  end here\nlast"}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    import time

    from pyspark.sql import functions as F

    from corpusloom.llm.runtime import stored

    def shuffles():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        names = [blocks.apply(k).toString() for k in range(blocks.size())]
        return {x.split("_")[1] for x in names if x.startswith("shuffle_")}

    before = shuffles()
    rows = spark.range(5000).groupBy((F.col("id") % 100).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    table = stored(rows, "counts")
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert sorted((r["x"], r["n"]) for r in table.collect()) == [(k, 50) for k in range(100)]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
