import random
from collections import defaultdict

from corpusloom.llm import line_runs
from corpusloom.llm.units import spans

from .test_dedup import brute_runs, cleaned

SCHEMA = "doc_id bigint, text string"


def brute_longest(rows):
    """(doc_id, pos) -> lines shared with an earlier suffix at most, and the earliest suffix that shares them."""
    lines = {d: [u.strip() for _, _, u in spans(t)] for d, t in rows}
    places = sorted((d, p) for d, own in lines.items() for p in range(len(own)))
    out = {}
    for k, (d, p) in enumerate(places):
        best = (0, None)
        for e, q in places[:k]:
            n = 0
            while p + n < len(lines[d]) and q + n < len(lines[e]) and lines[d][p + n] == lines[e][q + n]:
                n += 1
            if n > best[0]:
                best = (n, (e, q))
        if best[0]:
            out[d, p] = best
    return out


def longest(spark, rows):
    found = line_runs.longest_earlier(line_runs.levels(spark.createDataFrame(rows, SCHEMA)))
    return {(r["doc_id"], r["pos"]): (r["n"], (r["src_doc"], r["src_pos"])) for r in found.collect()}


def test_longest_common_prefixes_match_brute_force(spark):
    rng = random.Random(9)
    rows = [(1, "a\nb\nc\nd\ne"), (2, "z\na\nb\nc\nd\ne"), (3, "a\nb\nx"), (4, "c\nd"), (5, "s\ns\ns\ns\ns\ns\ns")]
    for k in range(6, 30):  # few letters: runs of all lengths, of many sources, that overlap
        rows.append((k, "\n".join(rng.choice("abcs") for _ in range(rng.randrange(1, 14)))))
    expected, found = brute_longest(rows), longest(spark, rows)
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in expected.items()}
    lines = {d: t.split("\n") for d, t in rows}
    for (d, p), (n, (e, q)) in found.items():
        assert (e, q) < (d, p) and lines[d][p : p + n] == lines[e][q : q + n]
    assert max(v[0] for v in expected.values()) > 4 and 3 in {v[0] for v in expected.values()}


def test_one_row_for_each_suffix_of_a_long_copy(spark):
    text = "\n".join(f"line {k}" for k in range(400))
    found = longest(spark, [(1, text), (2, f"own\n{text}")])
    assert len(found) == 400 and found[2, 1] == (400, (1, 0)) and found[2, 400] == (1, (1, 399))


def test_runs_count_by_their_words(spark):
    """Two short lines stay, five go; one line of nine words goes between unlike neighbours."""
    line = "a line of nine words that comes back often"
    rows = [(1, "Yes\nNo\nx"), (2, "w\nYes\nNo\nv"), (3, "k\nl\nm\nn\no"), (4, "u\nk\nl\nm\nn\no"), (5, "k\nl\nm\nn"), (6, f"p\n{line}\nq"), (7, f"r\n{line}\nt")]
    found = {r["doc_id"]: r["text"] for r in line_runs.dedup_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {**dict(rows), 4: "u", 7: "r\nt"}


def test_random_runs_match_brute_force(spark):
    rng = random.Random(3)
    pool = ["a", "b b", "c c c", "d d d d", "e e e e e"]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) + f"\nown {k} end of it all", None, None, None, None, None) for k in range(25)]
    done = line_runs.dedup_runs(spark.createDataFrame([r[:2] for r in rows], SCHEMA)).collect()
    gone = brute_runs(rows)
    assert gone and {r["doc_id"]: r["text"] for r in done} == {k[0]: k[1] for k in cleaned(rows, gone)}
    assert isinstance(gone, defaultdict)
