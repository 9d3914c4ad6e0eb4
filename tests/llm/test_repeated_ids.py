"""Rows that share a doc_id but not their text are documents of their own."""

import hashlib
import random

import pytest

from corpusloom.llm import line_runs, substrings

SCHEMA = "doc_id bigint, text string, variant int"
PASSAGE = " ".join(f"p{k}" for k in range(50))


def test_a_unique_text_of_a_repeated_id_stays(spark):
    own = "short other text entirely"
    docs = spark.createDataFrame([(1, PASSAGE, 9), (2, "own " + PASSAGE, 9), (2, own, 9)], SCHEMA)
    done = [(r["doc_id"], r["text"]) for r in substrings.dedup_passages(docs).collect()]
    assert sorted(done) == [(1, PASSAGE), (2, "own "), (2, own)]
    line, other = "one line of five words", "other line here which differs"
    docs = spark.createDataFrame([(1, line, 9), (2, line, 9), (2, other, 9)], SCHEMA)
    assert sorted((r["doc_id"], r["text"]) for r in line_runs.dedup_runs(docs).collect()) == [(1, line), (2, ""), (2, other)]
    assert sorted((r["doc_id"], r["text"], r["variant"]) for r in line_runs.dedup_documents(docs).collect()) == [(1, line, 9), (2, other, 9)]


@pytest.mark.parametrize("run", [substrings.dedup_passages, line_runs.dedup_runs])
def test_as_if_every_text_had_an_id_of_its_own(spark, run):
    rng = random.Random(31)
    lines = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(3, 12))) for _ in range(12)]
    passages = [" ".join(f"v{rng.randrange(900)}" for _ in range(70)) for _ in range(4)]
    rows = [(rng.randrange(25), "\n".join(rng.choice([*lines, rng.choice(passages), f"own {rng.random()} line of some words"]) for _ in range(rng.randrange(1, 7))), 0) for _ in range(90)]
    rows += [(7, None, 0), (7, "", 0), (None, lines[0], 0), rows[3], rows[3]]
    order = sorted({(d, t or "") for d, t, _ in rows if d is not None}, key=lambda x: (x[0], hashlib.md5(x[1].encode()).digest()))
    number = {x: k for k, x in enumerate(order)}
    want = {r["doc_id"]: (r["text"], r["removed"]) for r in run(spark.createDataFrame([(k, t, 0) for k, (_, t) in enumerate(order)], SCHEMA)).collect()}
    docs = spark.createDataFrame([(d, t, k) for k, (d, t, _) in enumerate(rows)], SCHEMA).repartition(4)
    done = run(docs).collect()
    assert len(done) == len(rows) and any(r["removed"] for r in done)
    for r in done:
        doc_id, text, _ = rows[r["variant"]]
        new, removed = (text, None) if doc_id is None else want[number[doc_id, text or ""]]
        assert ((r["text"] or ""), r["removed"]) == (new or "", removed) and (r["text"] is None) == (text is None)
