"""Recall of the similarity joins on large groups, against all pairs."""

import random

import numpy as np
import pytest

from corpusloom.llm import chosen_path, fingerprint
from corpusloom.llm.blocks import shingles_of


def hot_rows():
    """Near copies of one text with pairs spread around 0.8, texts around one passage, and extensions of these."""
    rng = random.Random(41)
    word = lambda: f"w{rng.randrange(10**7)}"
    base = [word() for _ in range(300)]
    texts = []
    for _ in range(1300):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(300)] = word()
        texts.append(own)
    passage = [word() for _ in range(60)]
    around = [[*(word() for _ in range(rng.randrange(0, 9))), *passage, *(word() for _ in range(rng.randrange(0, 9)))] for _ in range(600)]
    texts += around + [[*x, word(), word()] for x in around[:100]]
    return [(k, " ".join(x)) for k, x in enumerate(texts)]


def links_by_all_pairs(rows, threshold=0.8):
    sets = [np.unique(x) for x in shingles_of([t for _, t in rows])]
    known, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    often = np.flatnonzero(np.bincount(place) > 1)
    column = np.full(len(known), -1)
    column[often] = np.arange(len(often))
    table = np.zeros((len(sets), len(often)), np.float32)
    held = column[place] >= 0
    table[owner[held], column[place[held]]] = 1
    shared = (table @ table.T).astype(np.int64)
    sizes = np.array([len(x) for x in sets])
    alike = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
    np.fill_diagonal(alike, False)
    return alike.sum(axis=1)


@pytest.mark.parametrize("join", [chosen_path.jaccard_join, fingerprint.near_links])
def test_no_link_of_a_large_group_is_missed(spark, join):
    rows = hot_rows()
    want = links_by_all_pairs(rows)
    found = {r["doc_id"]: r["n_links"] for r in join(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect()}
    got = np.array([found[k] for k, _ in rows])
    print(f"{join.__name__}: {got.sum() // 2} of {want.sum() // 2} pairs")
    assert want.sum() // 2 > 200_000 and (got == want).all()
