"""Nodes against a plain dictionary of prefixes; the merge against sorting."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from corpusloom.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, digest string, path int"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_nodes(rows):
    """The contract, row by row."""
    turns = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            turns[conv_id].append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: tuple(x for _, x in sorted(v)) for c, v in turns.items()}
    members = defaultdict(list)
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c - 20 * int(c / 20))
        full = own.get(base, ())[:h] + seq[h:]
        for d in range(len(full) + 1):
            members[full[:d]].append((c, len(full)))
    below = defaultdict(lambda: [0, 0])
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, met in members.items():
        saved = (len(met) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0)
        for d in range(len(path) + 1):
            below[path[:d]][0] += children[path] == 0
            below[path[:d]][1] += saved
    out = []
    for path, met in members.items():
        ends = ",".join(str(c) for c, n in sorted(met) if n == len(path))
        up = min(c for c, _ in members[path[:-1]]) if path else None
        out.append((min(c for c, _ in met), len(path), up, len(met), children[path], *below[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, partitions=4):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        done = prefix_trie.trie(prefix_trie.rebuilt(table))
        assert done.columns == OUT
        return sorted((tuple(r) for r in done.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def rows():
    rng = random.Random(12)
    out = []
    for c in [*range(-45, 260), 10**12, 10**12 + 7]:
        for t in range(rng.choice((1, 1, 2, 3, 4, 5, 8))):
            out.append((c, t, rng.choice(("user", "assistant")), rng.choice(("hi", "hello  there\n you", "", "one two three four")), "d", 1))
    for c in range(300, 520):  # many copies of one conversation, more than a range holds
        out += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}", "d", 2) for t in range(6)]
    out += [(600, t, "user", "long " * (t % 3), "d", 3) for t in range(90)] + [(601, t, "user", "long " * (t % 3), "d", 3) for t in range(80)]
    out += [(700, None, None, None, None, None), (700, 0, "user", None, None, None), (700, 0, "user", None, None, None), (700, 0, "assistant", "x", None, None)]
    out += [(None, 1, "user", "nobody's", None, None), (None, None, None, None, None, None), (703, 0, "user", "alone", None, None)]
    return out


@pytest.mark.parametrize("partitions", [1, 4, 13, 40])
def test_nodes_equal_a_dictionary_of_prefixes(spark, partitions):
    assert found(spark, rows(), partitions) == plain_nodes(rows())


def test_runs_smaller_than_a_range(spark, monkeypatch):
    """Many short runs meet in the loser tree of each range."""
    small = rows()[:900]
    table = prefix_trie.rebuilt(spark.createDataFrame(small, SCHEMA)).collect()
    items = sorted((b"".join(map(bytes, r["digests"])), r["conv_id"], b"\1\0\0\0" * len(r["words"])) for r in table)
    rng = random.Random(5)
    for k in (1, 2, 3, 7, 40):
        runs = [[] for _ in range(k)]
        for item in items:
            runs[rng.randrange(k)].append(item)
        with_lcps = [[(*x, prefix_trie.shared(run[i - 1][0], x[0]) if i else 0) for i, x in enumerate(run)] for run in runs]
        merged = list(prefix_trie.LoserTree(with_lcps))
        assert [x[:3] for x in merged] == items
        assert [x[3] for x in merged] == [0, *(prefix_trie.shared(a[0], b[0]) for a, b in zip(items, items[1:]))]


def test_merging_does_not_compare_shared_turns_again(monkeypatch):
    """Copies of a long conversation are compared once from the beginning, and then from their ends."""
    key, calls = b"k" * prefix_trie.TURN * 500, []
    plain = prefix_trie.shared
    monkeypatch.setattr(prefix_trie, "shared", lambda a, b, known=0: calls.append(known) or plain(a, b, known))
    runs = [[(key, 10 * k + j, b"", 500 if k else 0) for k in range(50)] for j in range(4)]
    assert [x[1] for x in prefix_trie.LoserTree(runs)] == sorted(10 * k + j for k in range(50) for j in range(4))
    assert calls.count(0) <= 4 and set(calls) <= {0, 500}


def test_empty_and_single(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "x", None, None)]) == []
    one = [(20, 0, "user", "a b", None, None)]
    assert found(spark, one) == plain_nodes(one) and len(plain_nodes(one)) == 2


def test_a_conversation_without_turns_ends_in_the_root(spark):
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(alone, 0, "user", "a", None, None), (alone, 1, "assistant", "b", None, None)]
    assert found(spark, rows) == plain_nodes(rows)
    assert found(spark, rows)[0][1:5] == (0, None, 1, 0)
