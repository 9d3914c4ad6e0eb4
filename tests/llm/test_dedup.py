import hashlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import chosen_path, exact, fingerprint, line_runs, links
from corpusloom.llm.blocks import BASE, MinHash, shingles_of
from corpusloom.llm.units import spans, without

from . import cases


def order(row):
    return (row[0] is None, -(row[0] or 0), row[1] or "")


def test_fingerprints_match_brute_force(spark):
    rows = sorted(cases.rows(), key=order)
    hasher = MinHash(fingerprint.PERMUTATIONS)

    def mark(text):
        values = shingles_of([text])[0].tolist()
        a, b = hasher.a.tolist(), hasher.b.tolist()
        return [min(((x * p + q) % 2**64 >> 32 for x in values), default=2**32 - 1) for p, q in zip(a, b)]

    expected = Counter()
    for k, row in enumerate(rows):
        follower = rows[(k + 1) % len(rows)]
        same = [r for r in rows if r[0] == follower[0]]
        follower = same[0] if same[0] is not row else follower
        text, after = row[1] or "", follower[1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = mark(text), mark(changed), mark(after)
        expected[(row[0], len(text), hashlib.sha256(changed.encode()).hexdigest(), tuple(a), tuple(b), np.mean(np.equal(a, b)), np.mean(np.equal(a, c)))] += 1
    found = Counter()
    for r in fingerprint.fingerprints(cases.table(spark)).collect():
        a, b = (tuple(fingerprint.signature_of(x).tolist()) for x in (r["fingerprint"], r["edited_fingerprint"]))
        found[(r["doc_id"], r["n_chars"], r["edited_sha256"], a, b, r["near_edited"], r["near_next"])] += 1
    assert found == expected
    assert fingerprint.fingerprints(cases.empty(spark)).count() == 0


def test_one_document_follows_itself(spark):
    row = fingerprint.fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id bigint, text string")).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0


def brute_links(rows, threshold=0.8):
    sets = [frozenset(x.tolist()) for x in shingles_of([r[1] for r in rows])]
    n = len(rows)
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    count = [0] * n
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                count[i] += 1
                count[j] += 1
                a, b = find(i), find(j)
                parent[a] = b
    groups = defaultdict(list)
    for i in range(n):
        groups[find(i)].append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return Counter((rows[i][0], least[find(i)], count[i]) for i in range(n))


def test_joins_match_brute_force(spark, monkeypatch):
    expected = brute_links(cases.rows())
    for join in (chosen_path.jaccard_join, fingerprint.near_links):
        found = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in join(cases.table(spark)).collect())
        assert found == expected
        assert join(cases.empty(spark)).count() == 0
    monkeypatch.setattr(links, "SMALL", 3)
    monkeypatch.setattr(links, "BLOCK", 7)
    monkeypatch.setattr(links, "EDGES", 9)
    found = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in chosen_path.jaccard_join(cases.table(spark)).collect())
    assert found == expected


def test_keep_one(spark):
    rows = [r for r in cases.rows() if r[0] is not None]
    classes = {c for _, c, _ in brute_links(rows)}
    kept = chosen_path.keep_one(cases.table(spark))
    assert kept.columns == cases.table(spark).columns
    assert Counter(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == Counter(classes)
    assert kept.where("doc_id is null").count() == 2


def test_survival_is_no_less_than_simulated():
    rng = np.random.default_rng(0)
    common = rng.integers(0, 2**63, 800, dtype=np.uint64)
    a = np.sort(np.concatenate([common, rng.integers(0, 2**63, 100, dtype=np.uint64)]))
    b = np.sort(np.concatenate([common, rng.integers(0, 2**63, 100, dtype=np.uint64)]))
    met = 0
    for seed in range(200):
        start = np.array([seed * 7 + 1], dtype=np.uint64).view(np.int64)
        x = {m for m, _ in chosen_path.descend(a, start)}
        y = {m for m, _ in chosen_path.descend(b, start)}
        met += bool(x & y)
    assert met / 200 > chosen_path.survival(0.8, 2) - 0.1


def brute_runs(rows, least=line_runs.LEAST_WORDS):
    """Lines in a run of ``least`` words or more that equals an earlier one, by comparing all pairs of places."""
    lines = {}
    for r in rows:
        if r[0] is not None:
            lines[r[0]] = [u.strip() for _, _, u in spans(r[1] or "")]
    places = defaultdict(list)
    for d in sorted(lines):
        for p, u in enumerate(lines[d]):
            places[u].append((d, p))
    gone = defaultdict(set)
    for d, own in lines.items():
        for p, u in enumerate(own):
            for e, q in places[u]:
                if (e, q) >= (d, p):
                    break
                if p and q and own[p - 1] == lines[e][q - 1]:
                    continue  # not the begin of a run
                n = 0
                while p + n < len(own) and q + n < len(lines[e]) and own[p + n] == lines[e][q + n]:
                    n += 1
                if sum(len(x.split()) for x in own[p : p + n]) >= least:
                    gone[d] |= set(range(p, p + n))
    return gone


def cleaned(rows, gone):
    out = Counter()
    for r in rows:
        text, spent = without(r[1], gone[r[0]]) if r[1] and gone.get(r[0]) else (r[1], None)
        for begin, end in spent or []:
            assert "\n" not in r[1][begin:end]
        out[(r[0], text, tuple(spent) if spent is not None else None, r[5], r[6])] += 1
    return out


def test_line_dedup_matches_brute_force(spark):
    rows = cases.rows()
    done = line_runs.dedup_runs(cases.table(spark)).collect()
    found = Counter((r["doc_id"], r["text"], tuple(map(tuple, r["removed"])) if r["removed"] is not None else None, r["digest"], r["rank"]) for r in done)
    gone = brute_runs(rows)
    assert gone and found == cleaned(rows, gone)
    assert line_runs.dedup_runs(cases.empty(spark)).count() == 0


def brute_exact(rows):
    def low(text):
        return (text or "").encode().lower()

    keep, size = {}, Counter(low(r[1]) for r in rows)
    for r in rows:
        k = low(r[1])
        keep[k] = r[0] if keep.get(k) is None else max(keep[k], r[0]) if r[0] is not None else keep[k]
    return Counter((r[0], keep[low(r[1])], size[low(r[1])], r[0] == keep[low(r[1])], hashlib.sha256(low(r[1])).hexdigest()) for r in rows)


def test_exact_dedup_matches_brute_force(spark):
    rows = cases.rows()
    for digest_bytes, memtable in ((32, 50_000), (32, 5), (1, 7)):  # one byte: most hits are collisions
        found = exact.exact_groups(cases.table(spark), digest_bytes, memtable).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in found) == brute_exact(rows)
    assert exact.exact_groups(cases.empty(spark)).count() == 0


def test_bloom_filter_knows_all_it_was_given():
    digests = exact.as_numbers([hashlib.sha256(bytes([k])).digest() for k in range(200)])
    assert exact.Bloom(digests).may_have(digests).all()
    assert exact.Bloom(digests[:100]).may_have(digests[100:]).mean() < 0.1
    assert int(BASE) % 2 == 1
