"""Operator 11, byte-level BPE encoding and decoding by monoid tree reduction.

The element of the monoid is the token ids of a stretch of text. A long match is encoded
half by half, and two neighbours are joined by re-encoding a window of tokens around their
boundary, which doubles until the tokens outside of it are stable.

Stable means: merging never crosses the boundary of two tokens whose joint bytes merging
leaves as these two. Up to a first crossing, merging inside the two would go as if they were
alone, and alone they are not crossed. So a sequence is what merging makes of its bytes if
each two neighbours are what merging makes of theirs, and any part of such a sequence is one.

Texts of more than SEGMENT code points are cut into segments, which Spark deals out one by
one. Cuts lie where a match of the pattern ends whatever stands around it; only a match that
is longer than a segment is cut inside, and its parts are joined as above. Decoding
concatenates the tokens' bytes up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.blocks import buffers, slices
from corpusloom.llm.linear_features import texts_of
from corpusloom.llm.runtime import documents, holds, parts, stored, tidy

RANKS = "byte_bpe_50k.tiktoken"
#: Most code points of a text that one task encodes as a whole.
SEGMENT = 1 << 16
#: Most bytes of a match that isn't halved, of one whose ids are remembered, and of a window that is merged without a heap.
LEAF, SHORT, HEAP = 8, 12, 256
CACHED, PAIRS = 300_000, 2_000_000
NEVER = 1 << 62
# The characters of Unicode's White_Space.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE, LETTER, NUMBER, OTHER = range(4)


class Codec:
    """Encodes and decodes with the ranks of one vocabulary and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([k]) not in ranks for k in range(256)):
            raise ValueError("every single byte needs a rank")
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, k in ranks.items():
            self.tokens[k] = token
        self.longest = max(map(len, ranks))
        self.matches = regex.compile(pattern).findall
        self.chunks = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+").findall
        self.kind_of = regex.compile(r"(\s)|(\p{L})|(\p{N})").match
        self.kinds: dict[str, int] = {}
        self.pairs: dict[int, bool] = {}
        self.leaves: dict[bytes, list[int]] = {}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def parse(cls, raw: bytes, pattern: str) -> Codec:
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}, pattern)

    def merged(self, piece: bytes) -> list[int]:
        """What merging makes of some bytes: always the least rank, the leftmost of equals."""
        if len(piece) > HEAP:
            return self.merged_by_heap(piece)
        rank = self.ranks.get
        symbols = [piece[k : k + 1] for k in range(len(piece))]
        ranks = [rank(piece[k : k + 2], NEVER) for k in range(len(piece) - 1)]
        while ranks and (best := min(ranks)) != NEVER:
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank(symbols[at] + symbols[at + 1], NEVER)
            if at:
                ranks[at - 1] = rank(symbols[at - 1] + symbols[at], NEVER)
        return [self.ranks[x] for x in symbols]

    def merged_by_heap(self, piece: bytes) -> list[int]:
        n = len(piece)
        ends, before = list(range(1, n + 1)), list(range(-1, n))  # of the symbol that begins here; of the one before
        waiting = [(r, k) for k in range(n - 1) if (r := self.ranks.get(piece[k : k + 2])) is not None]
        heapq.heapify(waiting)
        while waiting:
            best, at = heapq.heappop(waiting)
            middle = ends[at]
            if middle <= at or middle >= n or self.ranks.get(piece[at : ends[middle]]) != best:
                continue  # merged meanwhile
            ends[at], ends[middle] = ends[middle], -1
            if (after := ends[at]) < n:
                before[after] = at
                if (r := self.ranks.get(piece[at : ends[after]])) is not None:
                    heapq.heappush(waiting, (r, at))
            if (left := before[at]) >= 0 and (r := self.ranks.get(piece[left : ends[at]])) is not None:
                heapq.heappush(waiting, (r, left))
        out, at = [], 0
        while at < n:
            out.append(self.ranks[piece[at : ends[at]]])
            at = ends[at]
        return out

    def fits(self, a: int, b: int) -> bool:
        """Whether merging leaves the joint bytes of two tokens as these two."""
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return found

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """The tokens of the joint bytes of two neighbours; ``a`` is extended in place."""
        if not a or not b:
            a += b
            return a
        if self.fits(a[-1], b[0]):
            a += b
            return a
        width = 1
        while True:
            i, j = max(0, len(a) - width), min(len(b), width)
            middle = self.leaf(b"".join([self.tokens[k] for k in (*a[i:], *b[:j])]))
            if (i == 0 or self.fits(a[i - 1], middle[0])) and (j == len(b) or self.fits(middle[-1], b[j])):
                del a[i:]
                a += middle
                a += b[j:]
                return a
            width *= 2

    def leaf(self, piece: bytes) -> list[int]:
        """What merging makes of some bytes, remembered if they are few."""
        if len(piece) > SHORT:
            return self.merged(piece)
        found = self.leaves.get(piece)
        if found is None:
            if len(self.leaves) > CACHED:
                self.leaves.clear()
            found = self.leaves[piece] = self.merged(piece)
        return found

    def reduced(self, piece: bytes) -> list[int]:
        """What merging makes of a match of any length, by halves."""
        if len(piece) <= LEAF:
            return list(self.leaf(piece))
        half = len(piece) // 2
        return self.join(self.reduced(piece[:half]), self.reduced(piece[half:]))

    def of_match(self, match: str) -> list[int]:
        piece = match.encode()
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.reduced(piece)

    def of_chunk(self, chunk: str) -> bytes:
        """Ids as bytes of blanks and what follows up to the next blank; nothing around them matters."""
        found = self.older.get(chunk)
        if found is None:
            found = np.array([k for match in self.matches(chunk) for k in self.of_match(match)], dtype="<u4").tobytes()
        if len(chunk) <= 64:
            if len(self.cache) >= CACHED:
                self.older, self.cache = self.cache, {}
            self.cache[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        known = self.cache.get
        return b"".join([known(chunk) or self.of_chunk(chunk) for chunk in self.chunks(text)])

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[k] for k in np.frombuffer(ids, "<u4").tolist()])

    def kind(self, character: str) -> int:
        found = self.kinds.get(character)
        if found is None:
            met = self.kind_of(character)
            found = self.kinds[character] = OTHER if met is None else met.lastindex - 1
        return found

    def ends_match(self, x: str, y: str) -> bool:
        """Whether no match holds ``x`` followed by ``y``, so that one ends between them."""
        a, b = self.kind(x), self.kind(y)
        return a != b and a != SPACE and not (x == "'" and b == LETTER)

    def inside_match(self, text: str, at: int) -> bool:
        """Whether ``at`` lies in a run of characters of a kind, more than a token after its start and two before its end."""
        kind = self.kind(text[at])
        return at + 1 < len(text) and at > self.longest and all(self.kind(text[k]) == kind for k in range(at - self.longest - 1, at + 2))

    def segments(self, text: str, most: int) -> Iterator[tuple[str, bool]]:
        """Parts of a text of at most ``most`` code points, and whether a part goes on with the match of the one before."""
        most, begin, glued = max(most, 4 * self.longest + 16), 0, False
        while len(text) - begin > most:
            end = begin + most
            at = next((k for k in range(end, begin, -1) if self.ends_match(text[k - 1], text[k])), 0)
            # without such a place there are three runs at most, and one of them is long
            inside = 0 if at else next(k for k in range(end, begin, -1) if self.inside_match(text, k))
            yield text[begin : at or inside], glued
            begin, glued = at or inside, not at
        yield text[begin:], glued

    def part(self, text: str, glued: bool) -> tuple[bytes, int, int]:
        """Ids of a segment, and how many of them belong to its first and to its last match (all, if it is one match)."""
        if not text:
            return b"", 0, 0
        matches = self.matches(text) if glued else None
        if matches is None:  # the last run of blanks and what follows it hold the last match
            chunks = self.chunks(text)
            body = self.encode(text[: len(text) - len(chunks[-1])])
            matches = self.matches(chunks[-1])
            first = None
        else:
            first, body = self.reduced(matches[0].encode()), b""
        out = list(first or ())
        for match in matches[first is not None :]:
            last = len(out)
            out += self.of_match(match)
        if first is not None and len(matches) == 1:
            last = 0
        head = len(first) if first is not None else 0
        return body + np.array(out, dtype="<u4").tobytes(), head, len(out) - last


class Tree:
    """Joins the segments of one text from left to right; of the match that is still open only, ids are kept."""

    def __init__(self, codec: Codec, take: Callable[[bytes], None]):
        self.codec, self.take, self.open = codec, take, []

    def add(self, ids: bytes, glued: bool, head: int, tail: int) -> None:
        if glued:
            first = np.frombuffer(ids[: 4 * head], "<u4").tolist()
            self.open = self.codec.join(self.open, first)
            ids = ids[4 * head :]
            if not ids:
                return  # the match may go on
        self.close()
        self.take(ids[: len(ids) - 4 * tail])
        self.open = np.frombuffer(ids[len(ids) - 4 * tail :], "<u4").tolist()

    def close(self) -> None:
        self.take(np.array(self.open, dtype="<u4").tobytes())
        self.open = []


class Digest:
    """Number of ids, SHA-256 of the ids and of the decoded bytes."""

    KINDS = [("n_tokens", pa.int64(), "bigint"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")]

    def __init__(self, codec: Codec):
        self.codec, self.n, self.ids, self.decoded = codec, 0, hashlib.sha256(), hashlib.sha256()

    def take(self, ids: bytes) -> None:
        self.n += len(ids) // 4
        self.ids.update(ids)
        self.decoded.update(self.codec.decode(ids))

    def row(self) -> tuple:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


class Ids:
    """The ids themselves."""

    KINDS = [("ids", pa.list_(pa.int32()), "array<int>")]

    def __init__(self, codec: Codec):
        self.parts: list[bytes] = []
        self.take = self.parts.append

    def row(self) -> tuple:
        return (np.frombuffer(b"".join(self.parts), "<i4"),)


_codecs: dict[bytes, Codec] = {}
holds("byte_pairs", _codecs.clear)


def codec(raw: bytes, pattern: str) -> Codec:
    """The codec of a rank file; a worker process keeps one."""
    key = hashlib.sha256(raw + pattern.encode()).digest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec.parse(raw, pattern)
    return _codecs[key]


def rank_file(path: str | None = None) -> bytes:
    with open(path or public_tokenizers.path(RANKS), "rb") as f:  # about a MB; the driver reads it and ships it with the task
        return f.read()


def encode(docs: DataFrame, raw: bytes, pattern: str = public_tokenizers.PATTERN, segment: int = SEGMENT) -> DataFrame:
    """doc_id, ids for every row of ``docs`` (doc_id, text).

    Null and empty texts have no ids. Repeated rows and rows without doc_id each give a row;
    ties don't matter, an empty table gives an empty result, and other columns are ignored.
    Texts of any length a row can hold are encoded whole.
    """
    return _run(docs, raw, pattern, segment, Ids)


def digests(docs: DataFrame, raw: bytes, pattern: str = public_tokenizers.PATTERN, segment: int = SEGMENT) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian 32-bit numbers), decoded_sha256 (of the ids decoded again); rows as for ``encode``."""
    return _run(docs, raw, pattern, segment, Digest)


def decode(rows: DataFrame, raw: bytes, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, text for every row of ``rows`` (doc_id, ids); null ids count as none, and bytes that aren't UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(raw, pattern)
        for batch in batches:
            texts = [own.decode(np.array(x.as_py() or [], dtype="<u4").tobytes()).decode(errors="replace") for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(tidy(run, "byte_pairs"), "doc_id bigint, text string")


def _run(docs: DataFrame, raw: bytes, pattern: str, segment: int, sink: type) -> DataFrame:
    names, kinds = ["doc_id", *(x[0] for x in sink.KINDS)], [pa.int64(), *(x[1] for x in sink.KINDS)]
    schema = "doc_id bigint, " + ", ".join(f"{a} {c}" for a, _, c in sink.KINDS)
    n = parts(docs.sparkSession)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], kind) for k, kind in enumerate(kinds)], names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(raw, pattern)
        for batch in batches:
            _, offsets = buffers(batch.column("text"))
            for first, last in slices(offsets):
                rows = []
                for doc_id, text in zip(batch.column("doc_id").slice(first, last - first).to_pylist(), batch.column("text").slice(first, last - first).to_pylist()):
                    out = sink(own)
                    out.take(own.encode(text))
                    rows.append((doc_id, *out.row()))
                yield batch_of(rows)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(raw, pattern)
        for batch in batches:
            for row in batch.to_pylist():
                for k, (text, glued) in enumerate(own.segments(row["text"], segment)):
                    yield pa.RecordBatch.from_pylist([{"row": row["row"], "part": k, "doc_id": row["doc_id"], "glued": glued, "text": text}], schema=pieces)

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(raw, pattern)
        for batch in batches:
            for row in batch.to_pylist():
                ids, head, tail = own.part(row.pop("text"), row["glued"])
                yield pa.RecordBatch.from_pylist([row | {"ids": ids, "head": head, "tail": tail}], schema=encoded)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(raw, pattern)
        at = None
        for batch in batches:
            for x in batch.to_pylist():
                if x["row"] != at:
                    if at is not None:
                        tree.close()
                        yield batch_of([(doc_id, *out.row())])
                    at, doc_id, out = x["row"], x["doc_id"], sink(own)
                    tree = Tree(own, out.take)
                tree.add(x["ids"], x["glued"], x["head"], x["tail"])
        if at is not None:
            tree.close()
            yield batch_of([(doc_id, *out.row())])

    pieces = pa.schema([("row", pa.int64()), ("part", pa.int64()), ("doc_id", pa.int64()), ("glued", pa.bool_()), ("text", pa.string())])
    encoded = pa.schema([*list(pieces)[:4], ("ids", pa.binary()), ("head", pa.int64()), ("tail", pa.int64())])
    texts = texts_of(docs)
    short = texts.where(F.length("text") <= segment).mapInArrow(tidy(whole, "byte_pairs"), schema)
    long = texts.where(F.length("text") > segment).withColumn("row", F.monotonically_increasing_id())
    cut = stored(long.mapInArrow(tidy(cut_up, "byte_pairs"), "row bigint, part bigint, doc_id bigint, glued boolean, text string"), "segments")
    ids = cut.repartition(n, "row", "part").mapInArrow(tidy(ids_of, "byte_pairs"), "row bigint, part bigint, doc_id bigint, glued boolean, ids binary, head bigint, tail bigint")
    return short.unionAll(ids.repartition(n, "row").sortWithinPartitions("row", "part").mapInArrow(tidy(joined, "byte_pairs"), schema))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), rank_file())
