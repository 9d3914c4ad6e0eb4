"""Rows without doc_id are documents like the others."""

import hashlib
import random
from collections import Counter

from corpusloom.llm import chosen_path, exact, fingerprint, links

from . import cases
from .test_dedup import brute_links


def near_rows():
    """Near copies of one text, some without doc_id; two documents that only one of these connects."""
    rng = random.Random(12)
    words = cases.prose(rng, 300, 10**6).split()
    texts = []
    for k in range(50):
        own = list(words)
        own[rng.randrange(300)] = f"n{k}"
        texts.append(" ".join(own))
    rows = [(None if k % 5 == 0 else k, t) for k, t in enumerate(texts)]
    words = cases.prose(rng, 300, 10**6).split()
    left, right = [*words[:-20], *(f"l{k}" for k in range(20))], [*(f"r{k}" for k in range(20)), *words[20:]]
    return [*rows, (100, " ".join(left)), (None, " ".join(words)), (None, " ".join(words)), (101, " ".join(right))]


def test_near_copies_without_id(spark, monkeypatch):
    expected = brute_links(near_rows())
    assert (101, 100, 2) in expected
    docs = spark.createDataFrame(near_rows(), "doc_id bigint, text string").repartition(3)
    monkeypatch.setattr(links, "SMALL", 3)
    for join in (chosen_path.jaccard_join, fingerprint.near_links):
        assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in join(docs).collect()) == expected


def test_short_digests_do_not_join_texts_without_ids(spark):
    """Bytes are compared where no row of a group has an id, and where some have."""
    texts = [f"text {k}" for k in range(600)] + ["Copy", "cOPY", "copy"]
    rows = [(None, t) for t in texts] + [(k, f"own {k}") for k in range(40)] + [(99, "copy")]
    done = exact.exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), digest_bytes=1).collect()
    sizes = Counter((t or "").lower() for _, t in rows)
    found = Counter((r["text_sha256"], r["group_size"]) for r in done)
    assert found == Counter((hashlib.sha256(t.lower().encode()).hexdigest(), sizes[t.lower()]) for _, t in rows)
    assert {r["keep_id"] for r in done if r["doc_id"] is None} == {None, 99}
