"""Operator 5, SentencePiece encoding and decoding.

An Aho-Corasick automaton over the vocabulary's pieces reports, through its output links,
every piece that ends at a position. One pass over the positions relaxes the best way to
reach each of them:

- unigram models: the largest sum of scores (Viterbi);
- BPE models: their scores are merge ranks, whose sum means nothing. A way is the right
  one if and only if each two neighbouring pieces are what merging makes of their joint
  text; of the pieces that end at a position exactly one continues a right way so.
  Chunks are relaxed side by side: the pass takes a position of all of them at a time.

Both give the ids of the public SentencePiece library for the same model file.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.blocks import buffers, slices
from corpusloom.llm.linear_features import texts_of
from corpusloom.llm.runtime import documents, holds, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Chunks (in each of two generations) and pairs of pieces that a worker remembers: some 15 and 12 MB, whatever the number of texts.
CACHED = 40_000
PAIRS = 120_000
#: Slots of the array of pairs before these, a power of two (8 MB).
SLOTS = 1 << 20
#: Code points of a chunk that is remembered and relaxed beside others, chunks that are so at a time, and bytes of text that are cut into them.
SHORT = 64
BESIDE = 1 << 13
TOGETHER = 3 << 16


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = raw[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(raw):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = raw[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


class Model:
    """A SentencePiece model file: pieces, scores, kinds, and the flags that encoding needs."""

    def __init__(self, pieces: list[tuple[str, float, int]], kind: int = UNIGRAM, prefix: bool = True, byte_fallback: bool = False):
        self.pieces, self.kind, self.prefix, self.byte_fallback = pieces, kind, prefix, byte_fallback

    @classmethod
    def parse(cls, raw: bytes) -> Model:
        pieces, kind, prefix, fallback = [], UNIGRAM, True, False
        for number, value in fields(raw):
            if number == 1:
                own = dict(fields(value))
                score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
                pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
            elif number == 2:
                own = dict(fields(value))
                kind, fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
            elif number == 3:
                own = dict(fields(value))
                prefix = bool(own.get(3, 1))
                if own.get(2) or own.get(4, 1):
                    raise ValueError("only models with identity normalisation that keep extra blanks are supported")
        if kind not in (UNIGRAM, BPE) or any(x[2] == USER for x in pieces):
            raise ValueError("only unigram and BPE models without user-defined symbols are supported")
        return cls(pieces, kind, prefix, fallback)


class Cache(dict):
    """Chunk -> ids as bytes, of at most 2 x CACHED chunks in two generations; ``encode`` takes many chunks."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def all(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk; equal ones are encoded once."""
        out = []
        for begin in range(0, len(chunks), CACHED):
            some = chunks[begin : begin + CACHED]
            needed = set(some)
            absent = needed.difference(self)
            if len(self) + len(absent) > CACHED:
                self.old = dict(self)
                self.clear()
                absent = needed
            new = list(absent.difference(self.old))
            self.update((x, self.old[x]) for x in absent.intersection(self.old))
            self.update(zip(new, self.encode(new)))
            out += map(self.__getitem__, some)
            for x in new:
                if len(x) > SHORT:
                    del self[x]
        return out


class Codec:
    """Encodes and decodes texts with one model."""

    def __init__(self, model: Model):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        self.ids: dict[str, int] = {}
        self.unknown, self.bytes = 0, [0] * 256
        self.plain: list[bytes] = []
        for k, (piece, score, kind) in enumerate(model.pieces):
            if kind == NORMAL:
                self.ids[piece] = k
                self.automaton.add_word(piece, k)
            elif kind == UNKNOWN:
                self.unknown = k
            elif kind == BYTE:
                self.bytes[int(piece[3:5], 16)] = k
            self.plain.append(bytes([int(piece[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else piece.replace(BLANK, " ").encode())
        self.automaton.make_automaton()
        self.scores = [x[1] for x in model.pieces]
        self.sizes = [len(x[0]) for x in model.pieces]
        self.lengths = np.array(self.sizes, np.int64)
        apart = not any(re.search(f"[^{BLANK}]{BLANK}", x) for x in self.ids)
        self.known = {x for x in self.ids if len(x) == 1}
        inside = "".join(map(re.escape, sorted(self.known - {BLANK})))  # no piece goes over an unknown character either
        self.chunks = re.compile(f"{BLANK}*[{inside}]+|{BLANK}+|[^{BLANK}{inside}]+" if apart and inside and model.kind == BPE else "(?s).+").findall
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        #: Two numbers beside those of pieces: what precedes a chunk's first piece, and a position that no right way reaches.
        self.begin, self.never = len(model.pieces), len(model.pieces) + 1
        #: Key of a pair << 1 | whether it fits, each at the slot of its key's hash.
        self.slots = np.full(SLOTS if model.kind == BPE else 1, -1, np.int64)
        if model.kind == BPE:
            self.tables()
        self.cache = Cache(self.side_by_side if model.kind == BPE else lambda chunks: [self.packed(self.viterbi(x)) for x in chunks])

    def normal(self, text: str) -> str:
        return (" " + text if self.model.prefix and text else text).replace(" ", BLANK)

    def fallback(self, character: str) -> list[int]:
        return [self.bytes[x] for x in character.encode()] if self.model.byte_fallback else [self.unknown]

    def merged(self, text: str) -> list[int]:
        """What merging makes of a text of known characters, the plain way; for short texts."""
        symbols = list(text)
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                found = self.ids.get(symbols[k] + symbols[k + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], k
            if best is None:
                return [self.ids[x] for x in symbols]
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def fits(self, a: int, b: int) -> bool:
        """Whether merging leaves the joint text of two pieces as these two."""
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(self.model.pieces[a][0] + self.model.pieces[b][0]) == [a, b]
        return found

    def fit(self, keys: np.ndarray) -> np.ndarray:
        """``fits`` for left << 32 | right, or ``alone`` where left is ``begin``; what isn't in the array of slots is asked once a pair."""
        at = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - SLOTS.bit_length())).view(np.int64)
        found = self.slots[at]
        good = (found & 1).astype(bool)
        missed = np.flatnonzero(found >> 1 != keys)
        if len(missed):
            asked, back = np.unique(keys[missed], return_inverse=True)
            told = np.array([False if a == self.never else self.alone(b) if a == self.begin else self.fits(a, b) for a, b in zip((asked >> 32).tolist(), (asked & 0xFFFFFFFF).tolist())], bool)
            good[missed] = told[back]
            self.slots[at[missed]] = keys[missed] << 1 | good[missed]
        return good

    def tables(self) -> None:
        """The automaton as arrays: sorted edges (state, character), where they lead, where a state without one fails to, and the pieces that end in each state, longest first."""
        states = {x: k for k, x in enumerate(sorted({x[:k] for x in self.ids for k in range(len(x) + 1)} | {""}, key=len))}
        self.kinds = np.zeros(0x110000, np.min_scalar_type(len(self.known)))  # of each code point: 0 for unknown characters
        for k, x in enumerate(sorted(self.known)):
            self.kinds[ord(x)] = k + 1
        self.width = len(self.known) + 1
        edges = sorted((states[x[:-1]] * self.width + int(self.kinds[ord(x[-1])]), k) for x, k in states.items() if k and x[-1] in self.known)
        self.edges, self.leads = np.array([*edges, (np.iinfo(np.int64).max, 0)], np.int64).T.copy()
        fails = [next((states[x[k:]] for k in range(1, len(x)) if x[k:] in states), 0) for x in states]
        ends: list[list[int]] = []
        for x, k in states.items():
            ends.append(([self.ids[x]] if x in self.ids else []) + (ends[fails[k]] if k else []))
        self.fails = np.array(fails, np.int64)
        self.ends = np.array([*chain.from_iterable(ends)], np.int64)
        self.ends_at = np.concatenate([[0], np.cumsum([len(x) for x in ends])])

    def step(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The automaton's next state of each of these, by its character."""
        out, left = np.zeros(len(state), np.int64), np.arange(len(state))
        while len(left):
            key = state * self.width + kind
            at = np.searchsorted(self.edges, key)
            met = self.edges[at] == key
            out[left[met]] = self.leads[at[met]]
            more = np.flatnonzero(~met & (state > 0))
            left, kind, state = left[more], kind[more], self.fails[state[more]]
        return out

    def side_by_side(self, chunks: list[str]) -> list[bytes]:
        """``bpe`` of many chunks, the first position of each, then the second, and so on.

        Chunks that no right way crosses (unknown characters, pieces that merging can't make) and long ones are encoded one by one.
        """
        out: list[bytes] = []
        for begin in range(0, len(chunks), BESIDE):
            out += self.beside(chunks[begin : begin + BESIDE])
        return out

    def beside(self, chunks: list[str]) -> list[bytes]:
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(-sizes, kind="stable")
        order = order[np.searchsorted(-sizes[order], -SHORT) :]
        sizes = sizes[order]
        first = np.cumsum(sizes + 1) - sizes - 1  # of a chunk's positions, one more than it has characters
        text = "\0".join([chunks[k] for k in order.tolist()])
        kinds = self.kinds[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        last, count = np.full(len(text) + 1, self.never, np.int64), np.zeros(len(text) + 1, np.int64)
        last[first] = self.begin
        state = np.zeros(len(order), np.int64)
        for k, n in enumerate(np.searchsorted(-sizes, -np.arange(sizes.max(initial=0))).tolist()):  # n chunks have over k characters
            state = self.step(state[:n], kinds[first[:n] + k])
            ends_at = self.ends_at[state]
            found = self.ends_at[state + 1] - ends_at
            upto = np.cumsum(found)
            piece = self.ends[np.arange(upto[-1]) + np.repeat(ends_at - upto + found, found)]
            to = np.repeat(first[:n] + k + 1, found)
            since = to - self.lengths[piece]
            good = np.flatnonzero(self.fit(last[since] << 32 | piece))[::-1]  # of one end the longest last, which overwrites others
            to = to[good]
            last[to] = piece[good]
            count[to] = count[since[good]] + 1
        at = first + sizes
        done = np.flatnonzero(last[at] < self.begin)
        at, mine = at[done], order[done].tolist()
        upto = np.cumsum(count[at])
        ids, place = np.empty(upto[-1] if len(upto) else 0, "<u4"), upto - 1
        while len(at):
            ids[place] = found = last[at]
            at = at - self.lengths[found]
            more = np.flatnonzero(last[at] < self.begin)
            at, place = at[more], place[more] - 1
        raw, begin = ids.tobytes(), 0
        packed = {}
        for k, end in zip(mine, (4 * upto).tolist()):
            packed[k], begin = raw[begin:end], end
        return [packed[k] if k in packed else self.packed(self.bpe(x)) for k, x in enumerate(chunks)]

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def bpe(self, chunk: str) -> list[int]:
        if self.known.issuperset(chunk):
            return self.bpe_known(chunk)
        out: list[int] = []
        begin = 0
        for k in range(len(chunk) + 1):
            if k == len(chunk) or chunk[k] not in self.known:
                if k > begin:
                    out += self.bpe_known(chunk[begin:k])
                if k < len(chunk):
                    out += self.fallback(chunk[k])
                begin = k + 1
        return out

    def bpe_known(self, text: str) -> list[int]:
        n = len(text)
        last, size = [-1] * (n + 1), [0] * (n + 1)
        ends = -1
        known = self.pairs.get
        for end, piece in self.automaton.iter(text):  # longest first at each end
            at, length = end + 1, self.sizes[piece]
            if at == ends:
                continue
            before = at - length
            if before == 0:
                good = self.alone(piece)
            elif (left := last[before]) < 0:
                continue
            elif (good := known(left << 32 | piece)) is None:
                good = self.fits(left, piece)
            if good:
                last[at], size[at], ends = piece, length, at
        out, at = [], n
        while at > 0:
            if last[at] < 0:
                return self.merged(text)  # a vocabulary with pieces that merging can't make
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    def alone(self, piece: int) -> bool:
        found = self.whole.get(piece)
        if found is None:
            found = self.whole[piece] = self.merged(self.model.pieces[piece][0]) == [piece]
        return found

    def viterbi(self, text: str) -> list[int]:
        """The best sum of scores; an unknown character costs ten below the least score, as in the library."""
        n = len(text)
        worst = min((self.scores[x] for x in self.ids.values()), default=0.0) - 10.0
        best, last, size = [0.0] + [-np.inf] * n, [-1] * (n + 1), [1] * (n + 1)
        done = 0  # positions up to here have been relaxed by their unknown character, if need be

        def close(to: int) -> None:
            nonlocal done
            while done < to:
                done += 1
                if text[done - 1] not in self.known and best[done - 1] + worst > best[done]:
                    best[done], last[done], size[done] = best[done - 1] + worst, -2, 1

        for end, piece in self.automaton.iter(text):
            at, length, score = end + 1, self.sizes[piece], self.scores[piece]
            close(at - 1)
            if best[at - length] + score > best[at]:
                best[at], last[at], size[at] = best[at - length] + score, piece, length
        close(n)
        out: list[int] = []
        at, joined = n, False
        while at > 0:
            if last[at] < 0:
                ids = self.fallback(text[at - 1])
                if self.model.byte_fallback or not joined:  # neighbouring unknown characters give one id
                    out += ids[::-1]
                joined = True
            else:
                out.append(last[at])
                joined = False
            at -= size[at]
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; chunks that several share are encoded once."""
        chunks, ends = [], []
        for text in texts:
            chunks += self.chunks(self.normal(text))
            ends.append(len(chunks))
        ids, begin = self.cache.all(chunks), 0
        for end in ends:
            yield np.frombuffer(b"".join(ids[begin:end]), dtype="<u4")
            begin = end

    def decode(self, ids: np.ndarray) -> str:
        plain = self.plain
        text = b"".join([plain[k] for k in ids.tolist()]).decode(errors="replace")
        return text[1:] if self.model.prefix and text[:1] == " " else text


_codecs: dict[bytes, Codec] = {}
holds("pieces", _codecs.clear)


def codec(raw: bytes) -> Codec:
    """The codec of a model file; a worker process keeps one."""
    key = hashlib.sha256(raw).digest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(Model.parse(raw))
    return _codecs[key]


def model_file(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:  # at most a few MB; the driver reads it and ships it with the task
        return f.read()


def encode(docs: DataFrame, raw: bytes) -> DataFrame:
    """doc_id, ids for every row of ``docs`` (doc_id, text); null and empty texts have no ids.

    Repeated rows and rows without doc_id each get a row; other columns are ignored.
    """
    return _run(docs, raw, lambda c, text, ids: (ids,), [("ids", pa.list_(pa.int32()), "array<int>")])


def decode(rows: DataFrame, raw: bytes) -> DataFrame:
    """doc_id, text for every row of ``rows`` (doc_id, ids).

    Null and empty ids give an empty text; ids of no piece fail. Repeated rows and rows without doc_id
    each give a row; ties don't matter, an empty table gives an empty result, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(raw)
        for batch in batches:
            texts = [own.decode(np.array(x.as_py() or [], dtype=np.int64)) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(tidy(run, "pieces"), "doc_id bigint, text string")


def digests(docs: DataFrame, raw: bytes) -> DataFrame:
    """doc_id, n_ids, n_bytes (ids that stand for single bytes), ids_sha256, round_trip.

    The digest is of the ids as little-endian 32-bit numbers; round_trip says that
    decoding gives the text again, which a text with U+2581 can't.
    """

    def one(c: Codec, text: str, ids: np.ndarray) -> tuple:
        low, high = min(c.bytes), max(c.bytes)
        return len(ids), int(((ids >= low) & (ids <= high)).sum()) if c.model.byte_fallback else 0, hashlib.sha256(ids.tobytes()).hexdigest(), c.decode(ids) == text

    kinds = [("n_ids", pa.int64(), "bigint"), ("n_bytes", pa.int64(), "bigint"), ("ids_sha256", pa.string(), "string"), ("round_trip", pa.bool_(), "boolean")]
    return _run(docs, raw, one, kinds)


def _run(docs: DataFrame, raw: bytes, one, kinds: list[tuple]) -> DataFrame:
    names = ["doc_id", *(x[0] for x in kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(raw)
        for batch in batches:
            _, offsets = buffers(batch.column("text"))
            for first, last in slices(offsets, TOGETHER):
                texts = batch.column("text").slice(first, last - first).to_pylist()
                out = [one(own, text, ids) for text, ids in zip(texts, own.encode_all(texts))]
                columns = [pa.array([x[k] for x in out], kind) for k, (_, kind, _) in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), *columns], names)

    return texts_of(docs).mapInArrow(tidy(run, "pieces"), "doc_id bigint, " + ", ".join(f"{a} {c}" for a, _, c in kinds))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``digests`` of all documents by the given model."""
    return digests(documents(spark, sf_dir), model_file())
