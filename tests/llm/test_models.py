import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from corpusloom.llm import chats, languages, mixing, pieces, quality
from corpusloom.llm.linear_features import column, remainder

from . import cases

SMALL = "/root/testdata/sf0.01"
TRICKY = ["", " ", "   a", "\n\n", "a" * 90, "Hello  wörld\n ñ 🎉 x ", "https://www.example.com/?x=1 {[(<>)]} \t\t 中文字符 ㍿", "  ", "zażółć gęślą"]


def test_crc_remainder(spark):
    import zlib

    rows = spark.createDataFrame([(k,) for k in (0, 7, 123456)], "doc_id bigint").select("doc_id", remainder(F.col("doc_id"), 3).alias("r")).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == r["r"] for r in rows)


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = languages.op8_language_id(spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(found) > 200 and (found.lang == found.lang_pred).mean() > 0.98 and found.ambiguous.mean() < 0.02


def test_languages_odd_cases(spark):
    docs = cases.table(spark)
    found = languages.identify(docs, languages.train(docs)).toPandas()
    assert len(found) == docs.count() and found.score.between(0, 1).all()
    expected = Counter("und" if not any(c.isalpha() for c in r[1] or "") else "known" for r in cases.rows())
    assert Counter("und" if x == "und" else "known" for x in found.lang_pred) == expected
    none = cases.empty(spark)
    assert languages.train(none) is None and languages.identify(none, None).count() == 0
    assert set(languages.identify(docs, None).toPandas().lang_pred) == {"und"}


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 5, 9, 30):
        code = languages.codewords(n)
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= (1 if n == 2 else 2)
        assert all(abs(c.sum()) < n for c in code.T)


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    size = quality.FIRST_WORD + (1 << quality.BITS)
    cuts = np.sort(rng.random((16, quality.CUTS - 1)), axis=1)
    machine = quality.Machine(cuts, 0.3, rng.normal(size=size), rng.normal(size=(size, quality.RANK)))
    texts = ["a b c a", "", "Some | words, 42!"]
    index, value, owner = quality.features(*column(texts), cuts)
    out, _ = quality.raw(machine, index, value, owner, 3)
    for k in range(3):
        mine = [(i, v) for i, v, o in zip(index, value, owner) if o == k]
        pairs = sum(machine.factors[a] @ machine.factors[b] * x * y for (a, x), (b, y) in itertools.combinations(mine, 2))
        assert out[k] == pytest.approx(0.3 + sum(machine.linear[i] * v for i, v in mine) + pairs)


def test_quality_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = quality.op3_quality(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").toPandas()
    good, bad = found[found.quality == 1].score.to_numpy(), found[found.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert (found.predicted == (found.score >= 0.3)).all() and (found.predicted == found.quality).mean() > 0.95


def test_quality_odd_cases(spark):
    docs, labels = cases.table(spark), spark.createDataFrame([(3, 1, 0), (3, 1, 0), (None, 0, 1), (30, None, 0), (33, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert quality.quality(docs, quality.train(docs, labels)).count() == docs.count()
    assert quality.train(docs, labels.limit(0)) is None and quality.quality(docs, None).count() == docs.count()
    assert quality.quality(cases.empty(spark), quality.train(docs, labels)).count() == 0


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.Model.parse(pieces.model_file()))


def test_bpe_ids_are_the_librarys(spark, codec):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = TRICKY + [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(200).collect()]
    for text in texts:
        ids = codec.encode(text)
        assert ids.tolist() == library.encode(text)
        assert codec.decode(ids) == text


def test_chunks_are_relaxed_side_by_side(spark, monkeypatch):
    alone = []
    plain = pieces.Codec.bpe
    monkeypatch.setattr(pieces.Codec, "bpe", lambda self, chunk: alone.append(chunk) or plain(self, chunk))
    own = pieces.Codec(pieces.Model.parse(pieces.model_file()))
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(5)
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(300).collect()]
    some = sorted(set("".join(texts)))
    texts += ["".join(rng.choice(some + list("  \n\0▁é漢🎉x")) for _ in range(rng.randrange(200))) for _ in range(300)]
    texts += ["", "x" * 64, "ab" * 33, "a\nb", "\0", "▁", "▁▁ ▁\n▁"]
    assert [x.tolist() for x in own.encode_all(texts)] == library.encode(texts)
    assert all(len(x) > pieces.SHORT or not own.known.issuperset(x) for x in alone)  # no other chunk is encoded by itself
    short = {x for text in texts for x in own.chunks(own.normal(text)) if x not in alone}
    assert len(short) > 10_000 > 20 * len(set(alone))


def test_bpe_of_other_vocabularies_is_plain_merging():
    rng = random.Random(6)
    for _ in range(60):
        words = list("abc▁"[: rng.randrange(2, 5)])
        for _ in range(rng.randrange(12)):  # each made of two others, some of a blank inside
            words.append(rng.choice(words) + rng.choice(words))
        words = list(dict.fromkeys(words))
        own = pieces.Codec(pieces.Model([("<unk>", 0.0, pieces.UNKNOWN)] + [(w, -float(k), pieces.NORMAL) for k, w in enumerate(words)], pieces.BPE))
        texts = ["".join(rng.choice("abbc d") for _ in range(rng.randrange(1, 90))) for _ in range(40)]
        for text, ids in zip(texts, own.encode_all(texts)):
            runs = re.findall(f"[{''.join(own.known)}]+|[^{''.join(own.known)}]", own.normal(text))
            assert ids.tolist() == [k for x in runs for k in (own.merged(x) if x[0] in own.known else [0])]


def test_viterbi_matches_brute_force():
    rng = random.Random(2)
    words = ["a", "b", "c", "ab", "bc", "abc", "ca", "aab", "▁", "▁a"]
    model = pieces.Model([("<unk>", 0.0, pieces.UNKNOWN)] + [(w, -rng.random() * 5, pieces.NORMAL) for w in words], pieces.UNIGRAM)
    own = pieces.Codec(model)
    score = {w: s for w, s, _ in model.pieces[1:]}

    def best(text):
        if not text:
            return 0.0
        return max(score[text[:k]] + best(text[k:]) for k in range(1, len(text) + 1) if text[:k] in score)

    for _ in range(200):
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 9)))
        ids = own.encode(text).tolist()
        assert sum(model.pieces[k][1] for k in ids) == pytest.approx(best(own.normal(text)))
        assert own.decode(np.array(ids)) == text
    assert own.encode("axxb").tolist().count(0) == 1


def test_encoding_odd_cases(spark):
    raw, docs = pieces.model_file(), cases.table(spark)
    done = pieces.digests(docs, raw)
    assert done.count() == docs.count() and done.where("not round_trip").count() == 0
    back = pieces.decode(pieces.encode(docs, raw), raw)
    assert Counter(back.collect()) == Counter((r[0], r[1] or "") for r in cases.rows())
    assert pieces.encode(cases.empty(spark), raw).count() == 0


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, target, fixed = sum(sizes.values()), {}, {}
    while True:
        rest = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if weight[s] * level > 3 * sizes[s]]
        target = {s: fixed.get(s, weight[s] * level) for s in order}
        if not over:
            return target
        fixed |= {s: 3 * sizes[s] for s in over}


def check_mix(rows, found):
    sizes, largest = Counter(), Counter()
    for source, size in rows:
        sizes[source] += size
        largest[source] = max(largest[source], size)
    target, taken = brute_targets(sizes), Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    monkeypatch.setattr(mixing, "FAN", 3)
    docs = cases.table(spark)
    found = mixing.mixed(docs).collect()
    check_mix([(r[3], len((r[1] or "").split())) for r in cases.rows()], found)
    assert Counter(found) == Counter(mixing.mixed(docs.repartition(7)).collect())
    assert mixing.mixed(cases.empty(spark)).count() == 0
    kept = mixing.take(docs)
    assert kept.columns == docs.columns
    taken = Counter()
    for r in found:
        taken[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in kept.collect()) == +taken


def test_mixing_caps(spark):
    rows = [(k, "w " * n, s) for k, (n, s) in enumerate([(1, "a"), (2, "b"), (900, "c"), (0, "d"), (50, "c"), (3, None)])]
    found = mixing.mixed(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    check_mix([(s, len(t.split())) for _, t, s in rows], found)


def test_pivot_keeps_words_and_expectation():
    rng = np.random.default_rng(0)
    draws = np.array([mixing.pivot(0.3, 7, 0.6, 4, x) for x in rng.random(20000)])
    assert np.allclose(draws @ [7, 4], 0.3 * 7 + 0.6 * 4)
    assert np.abs(draws.mean(axis=0) - [0.3, 0.6]).max() < 0.02
    assert all(a in (0, 1) or b in (0, 1) for a, b in draws)


def brute_repair(roles):
    """The least cost over all ways, one step at a time."""
    best = {(0, chats.START): 0}
    for k in range(len(roles)):
        for _ in range(3):
            for state in chats.STATE_ALL:
                if (k, state) in best:
                    for q in chats.NEXT[state]:
                        key = (k, chats.STATE[q])
                        best[key] = min(best.get(key, 10**9), best[k, state] + chats.INSERT)
        for state in chats.STATE_ALL:
            if (k, state) not in best:
                continue
            for q in chats.NEXT[state]:
                key = (k + 1, chats.STATE[q])
                best[key] = min(best.get(key, 10**9), best[k, state] + chats.relabel(roles[k], q))
            if state != chats.START:
                key = (k + 1, state)
                best[key] = min(best.get(key, 10**9), best[k, state] + chats.MERGE + chats.relabel(roles[k], chats.ROLE[state]))
    return min(best[len(roles), s] for s in chats.STATE_ALL if (len(roles), s) in best)


def test_role_repair_is_cheapest():
    for n in range(1, 6):
        for roles in itertools.product(("system", "user", "assistant", None), repeat=n):
            cost, _ = chats.repair(list(roles))
            assert cost == brute_repair(roles)


def test_formatted(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "User ", None, "tool"]), f"text {c} {t}", "clash") for c in range(12) for t in range(rng.randrange(1, 9))]
    rows += [(50, t, rng.choice(["user", "assistant"]), f"t{t}", "x") for t in range(60)] + [(51, 0, "user", "a", "x")] * 3 + [(52, None, "user", None, "x"), (52, 1, "user", "", "x"), (None, 0, "user", "q", "x")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, action string")
    results = []
    for block in (512, 5):
        monkeypatch.setattr(chats, "BLOCK", block)
        found = chats.formatted(turns.repartition(3)).collect()
        results.append(Counter((r["conv_id"], r["turn"], r["out_turn"], r["role"], r["action"], r["rendered"]) for r in found))
        by = defaultdict(list)
        for r in found:
            by[r["conv_id"]].append(r)
        assert sum(r["action"] != "insert" for r in found) == len(rows)
        for conv_id, own in by.items():
            own.sort(key=lambda r: (r["out_turn"], r["part"]))
            roles = [own[k]["role"] for k in range(len(own)) if own[k]["part"] == -1]
            state = chats.START
            for role in roles:
                assert role in chats.NEXT[state]
                state = chats.STATE[role]
            text = "".join(r["rendered"] for r in own)
            assert text.count("<|end|>") == len(roles) and text.endswith("<|end|>\n")
            mine = sorted((r for r in rows if r[0] == conv_id), key=lambda r: (r[1] is None, r[1] or 0, (r[2] or "").strip().lower(), r[3] or ""))
            if len({r[1] for r in mine}) == len(mine):
                known = [(r[2] or "").strip().lower() for r in mine]
                cost = sum(chats.INSERT if r["action"] == "insert" else 0 for r in own)
                given = {r[1]: k if k in chats.ROLES else None for r, k in zip(mine, known)}
                cost += sum((chats.MERGE if r["action"] == "merge" else 0) + chats.relabel(given[r["turn"]], r["role"]) for r in own if r["action"] != "insert")
                assert cost == brute_repair(list(given.values()))
    assert results[0] == results[1]
    assert chats.formatted(turns.limit(0)).count() == 0


def test_what_a_worker_remembers_of_pieces_is_bounded():
    own = pieces.Codec(pieces.Model.parse(pieces.model_file()))
    texts = [" ".join(f"q{k:x}z" for k in range(begin, begin + 1000)) for begin in range(0, 180_000, 1000)]
    for text in texts:
        own.encode(text)
    assert 0 < len(own.cache) + len(own.cache.old) <= 120_000 and len(own.pairs) <= 250_000
    own.pairs = dict.fromkeys(range(1 << 50, (1 << 50) + pieces.PAIRS), True)  # full
    ids = own.encode("unheard-of " + texts[0])
    assert len(own.pairs) < pieces.PAIRS
    assert ids.tolist() == pieces.Codec(own.model).encode("unheard-of " + texts[0]).tolist()
