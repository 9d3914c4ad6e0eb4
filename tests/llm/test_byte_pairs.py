"""Ids against the public library, halves and segments at every kind of boundary."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from corpusloom.llm import byte_pairs

from . import cases

RAW = byte_pairs.rank_file()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RAW.splitlines())}
PUBLIC = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = byte_pairs.Codec(RANKS, public_tokenizers.PATTERN)
ALPHABET = ["a", "b", "s", "'", "'s", "'re", " ", "  ", "\n", "\t", " ", "\x85", "\x1c", "1", "23", "½", "é", "中", "🎉", "!", "--", "=", "the", " of", "́", "<|endoftext|>"]


def texts():
    rng = random.Random(7)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    for unit in ("a", "ab", "the", "-", "=-", "1", " ", "\n", " \n", "中文", "é", "'", "' ", "!'s", "xyzzy"):
        out += [unit * k for k in (1, 7, 40, 333, 2500)] + [f" {unit * 900}'s{unit * 800} b", f"x {unit * 1501}"]
    out += ["".join(rng.choice("abcdefgh") for _ in range(4000)), "".join(rng.choice("the ofand'") for _ in range(6000)), "a" * 700 + "1" * 700 + " " * 700 + "!" * 700]
    return out


def public(text):
    return np.array(PUBLIC.encode_ordinary(text), dtype="<u4").tobytes()


def test_ids_equal_the_library():
    for text in texts():
        ids = CODEC.encode(text)
        assert ids == public(text), text[:80]
        assert CODEC.decode(ids) == text.encode()


def test_blanks_are_the_pattern_s():
    every = "".join(chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000)
    assert re.findall(f"[{byte_pairs.BLANKS}]", every) == regex.findall(r"\s", every)


def test_merging_by_heap_and_by_halves():
    rng = random.Random(3)
    for _ in range(300):
        piece = bytes(rng.choice(b"aabcde \xc3\xa9") for _ in range(rng.randrange(1, 400)))
        want = PUBLIC._encode_single_piece(piece) if piece not in RANKS else [RANKS[piece]]
        assert CODEC.merged_by_heap(piece) == CODEC.reduced(piece) == want


@pytest.mark.parametrize("most", [1, 600, 1000])
def test_segments_join_to_the_same_ids(most):
    for text in texts():
        if len(text) < 500:
            continue
        parts = list(CODEC.segments(text, most))
        assert "".join(x for x, _ in parts) == text and max(len(x) for x, _ in parts) <= 4 * CODEC.longest + 16 + most
        taken = []
        tree = byte_pairs.Tree(CODEC, taken.append)
        for part, glued in parts:
            ids, head, tail = CODEC.part(part, glued)
            tree.add(ids, glued, head, tail)
        tree.close()
        assert b"".join(taken) == public(text), text[:80]


def test_a_token_that_merging_does_not_reach():
    """The library looks a whole match up before it merges."""
    ranks = {bytes([k]): k for k in range(256)} | {b"xyz": 256}
    own = byte_pairs.Codec(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("xyz", "xyzx", "a xyz", "xyz xyz"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_rows(spark):
    docs = cases.table(spark)
    want = sorted((str(r[0]), r[1] or "") for r in cases.rows())
    for segment in (1, 300, byte_pairs.SEGMENT):
        done = byte_pairs.digests(docs, RAW, segment=segment).collect()
        got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in done)
        assert got == sorted((d, len(public(t)) // 4, hashlib.sha256(public(t)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, t in want)
    back = byte_pairs.decode(byte_pairs.encode(docs, RAW, segment=2000), RAW).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == want
    assert byte_pairs.digests(cases.empty(spark), RAW).count() == 0


def test_query_equals_the_library(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    done = byte_pairs.op11_byte_bpe(spark, "/root/testdata/sf0.01")
    assert done.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = done.collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = public(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids) // 4 and r["ids_sha256"] == hashlib.sha256(ids).hexdigest() and r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
