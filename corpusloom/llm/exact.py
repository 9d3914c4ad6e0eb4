"""Operator 6, exact dedup by a log-structured merge index of digests.

Each task keeps a memtable of digest -> (kept id, count) and flushes it as a sorted run
with a Bloom filter whenever it is full. Compaction brings the runs of each range of
digests together and merges FAN of them at a time, tier by tier: entries that no other run's filter
knows pass through, the rest are merged, keeping the preferred identifier and adding counts. Every document
whose digest is in a merged entry of two or more is a hit, and its bytes are compared with
those of the kept document; hits that differ are grouped again by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.blocks import buffers
from corpusloom.llm.runtime import cut, documents, parts, tidy, whole_number

MEMTABLE = 50_000
FILTER_BITS = 16
#: Runs that one step of the compaction merges.
FAN = 8
SHARD_ROWS = 400_000
NO_ID = -(1 << 63)


def folded(text: bytes) -> bytes:
    """A-Z in lower case, all other bytes as they are."""
    return text.lower()


def folded_rows(column: pa.Array) -> Iterator[bytes]:
    """The folded bytes of each row."""
    data, offsets = buffers(column)
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield folded(data[a:b].tobytes())


class Bloom:
    """A Bloom filter of digests, FILTER_BITS bits for each, three probes."""

    def __init__(self, digests: np.ndarray | None = None, raw: bytes | None = None):
        if raw is not None:
            self.bits = np.frombuffer(raw, np.uint8)
            return
        size = max(64, 1 << int(np.ceil(np.log2(max(1, len(digests)) * FILTER_BITS))))
        self.bits = np.zeros(size // 8, np.uint8)
        for at in self.places(digests):
            np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def places(self, digests: np.ndarray) -> list[np.ndarray]:
        size = len(self.bits) * 8
        return [(digests[:, k].astype(np.uint64) % np.uint64(size)).astype(np.int64) for k in range(3)]

    def may_have(self, digests: np.ndarray) -> np.ndarray:
        out = np.ones(len(digests), bool)
        for at in self.places(digests):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out


def as_numbers(digests: list[bytes]) -> np.ndarray:
    """The leading 24 bytes of each digest as three integers (padded where it is shorter)."""
    return np.frombuffer(b"".join(d[:24].ljust(24, b"\0") for d in digests), ">u8").reshape(-1, 3)


def shard_of(digest: bytes, shards: int) -> int:
    return (int.from_bytes(digest[:4].ljust(4, b"\0")) * shards) >> 32


def flush(memtable: dict[bytes, list], run: int, shards: int) -> Iterator[tuple]:
    """A memtable as sorted runs, one for each shard: (shard, run, digest, keep, n, filter of the run's first row)."""
    order = sorted(memtable)
    begin = 0
    while begin < len(order):
        shard, end = shard_of(order[begin], shards), begin
        while end < len(order) and shard_of(order[end], shards) == shard:
            end += 1
        part = order[begin:end]
        sieve = Bloom(as_numbers(part)).bits.tobytes()
        for k, digest in enumerate(part):
            keep, n = memtable[digest]
            yield shard, run, digest, keep, n, None if k else sieve
        begin = end


def merged_run(runs: list[dict]) -> dict:
    """Up to FAN sorted runs as one. Entries whose digest no other run's filter knows pass through; the rest are
    merged, keeping the largest identifier and adding counts."""
    sieves = [Bloom(raw=run["filter"]) for run in runs]
    out: list[tuple[bytes, int, int]] = []
    hits: dict[bytes, list[int]] = {}
    for a, run in enumerate(runs):
        numbers = as_numbers(run["digest"])
        other = np.zeros(len(numbers), bool)
        for b, sieve in enumerate(sieves):
            if b != a:
                other |= sieve.may_have(numbers)
        for digest, keep, n, hit in zip(run["digest"], run["keep"], run["n"], other):
            if not hit:
                out.append((digest, keep, n))
            elif (entry := hits.get(digest)) is None:
                hits[digest] = [keep, n]
            else:
                entry[0], entry[1] = max(entry[0], keep), entry[1] + n
    out += [(digest, keep, n) for digest, (keep, n) in hits.items()]
    out.sort()
    digests, keeps, counts = (list(x) for x in zip(*out))
    return {"digest": digests, "keep": keeps, "n": counts, "filter": Bloom(as_numbers(digests)).bits.tobytes()}


def compact(runs: list[dict]) -> dict | None:
    """All entries of the runs of one shard, each digest once. Tier by tier FAN runs become one, so each entry
    meets FAN - 1 filters in each of the tiers, however many runs there are."""
    while len(runs) > 1:
        runs = [merged_run(runs[k : k + FAN]) if k + 1 < len(runs) else runs[k] for k in range(0, len(runs), FAN)]
    return runs[0] if runs else None


def index(digests: DataFrame, shards: int, memtable_rows: int = MEMTABLE) -> DataFrame:
    """The compacted index of (doc_id, digest): digest, keep_id (largest), n."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memtable: dict[bytes, list] = {}
        run = TaskContext.get().partitionId() << 32  # a task that runs again names its runs alike
        for batch in batches:
            for doc_id, digest in zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist()):
                doc_id = NO_ID if doc_id is None else doc_id
                entry = memtable.get(digest)
                if entry is None:
                    memtable[digest] = [doc_id, 1]
                else:
                    entry[0], entry[1] = max(entry[0], doc_id), entry[1] + 1
                if len(memtable) >= memtable_rows:
                    yield table(flush(memtable, run, shards))
                    memtable, run = {}, run + 1
        if memtable:
            yield table(flush(memtable, run, shards))

    def table(rows: Iterator[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "run", "digest", "keep", "n", "filter"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, runs = None, {}
        for batch in batches:
            for s, r, digest, keep, n, sieve in zip(*(batch.column(c).to_pylist() for c in ("shard", "run", "digest", "keep", "n", "filter"))):
                if s != shard:
                    yield from merged(runs)
                    shard, runs = s, {}
                run = runs.setdefault(r, {"digest": [], "keep": [], "n": [], "filter": None})
                run["digest"].append(digest)
                run["keep"].append(keep)
                run["n"].append(n)
                run["filter"] = sieve or run["filter"]
        yield from merged(runs)

    def merged(runs: dict) -> Iterator[pa.RecordBatch]:
        done = compact(list(runs.values()))
        if done is not None:
            columns = [pa.array(done["digest"], pa.binary()), pa.array(done["keep"], pa.int64()), pa.array(done["n"], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "keep_id", "n"])

    n = parts(digests.sparkSession)
    runs = digests.mapInArrow(tidy(build), "shard int, run bigint, digest binary, keep bigint, n bigint, filter binary")
    dealt = runs.repartition(n, "shard").sortWithinPartitions("shard", "run", "digest")
    return dealt.mapInArrow(tidy(merge), "digest binary, keep_id bigint, n bigint")


def exact_groups(docs: DataFrame, digest_bytes: int = 32, memtable_rows: int = MEMTABLE) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text).

    Texts are equal if identical after lower-casing A-Z; null counts as empty. The largest
    doc_id of equal texts stays; rows without doc_id come last and share a null keep_id if
    nothing else is in their group. Rows that repeat doc_id and text are copies and all
    marked as kept when theirs is the kept id. ``digest_bytes`` under 32 makes the index
    meet collisions, which byte verification resolves; it never changes the result.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [hashlib.sha256(x).digest() for x in folded_rows(batch.column("raw"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[:digest_bytes] for x in whole], pa.binary()), pa.array([x.hex() for x in whole])], ["doc_id", "digest", "text_sha256"]
            )

    base = docs.select(whole_number("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    known = cut(base.mapInArrow(tidy(digests), "doc_id bigint, digest binary, text_sha256 string"))
    shards = max(16, parts(docs.sparkSession) * 2, known.count() // SHARD_ROWS)
    entries = index(known.select("doc_id", "digest"), shards, memtable_rows).where("n > 1")
    hits = cut(entries)
    placed = cut(known.join(hits, "digest", "left"))
    strays = byte_strays(base, placed.where("n is not null"), hits, digest_bytes)
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.when(F.col("keep_id") != NO_ID, F.col("keep_id")))
    out = placed.select("doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"), "text_sha256", "digest")
    if not strays.isEmpty():
        apart = strays.select("digest").distinct()
        again = placed.join(apart, "digest").groupBy("text_sha256").agg(F.max("doc_id").alias("k"), F.count(F.lit(1)).alias("g"))
        out = out.join(again, "text_sha256", "left").select(
            "doc_id",
            F.when(F.col("g").isNull(), F.col("keep_id")).otherwise(F.col("k")).alias("keep_id"),
            F.coalesce("g", "group_size").alias("group_size"),
            "text_sha256",
        )
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def byte_strays(base: DataFrame, members: DataFrame, hits: DataFrame, digest_bytes: int) -> DataFrame:
    """Digests of the hits whose bytes differ from their kept document's: (digest, doc_id).

    Kept texts move to the hits of their own id by an equi-join that Spark can split where
    one text has very many copies. Rows without doc_id are met by their digests, and compared
    with the least of their texts where none of a group has an id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = [a != b for a, b in zip(folded_rows(batch.column("raw")), folded_rows(batch.column("kept_raw")))]
            yield batch.select(["digest", "doc_id"]).filter(pa.array(differ))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [hashlib.sha256(x).digest()[: len(d)] == d for x, d in zip(folded_rows(batch.column("raw")), batch.column("digest").to_pylist())]
            yield batch.filter(pa.array(same))

    def stamped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [hashlib.sha256(x).digest()[:digest_bytes] for x in folded_rows(batch.column("raw"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digests, pa.binary()), batch.column("raw")], ["doc_id", "digest", "raw"])

    nameless = base.where(F.col("doc_id").isNull()).mapInArrow(tidy(stamped), "doc_id bigint, digest binary, raw binary")
    ids = members.where(F.col("doc_id").isNotNull()).select("doc_id", "digest", "keep_id")
    texts = ids.join(base, "doc_id").mapInArrow(tidy(own), "doc_id bigint, digest binary, keep_id bigint, raw binary")
    texts = cut(texts.unionByName(nameless.join(hits.select("digest", "keep_id"), "digest").select(*texts.columns)))
    kept = cut(texts.where((F.col("doc_id") == F.col("keep_id")) | (F.col("keep_id") == NO_ID)).groupBy("digest").agg(F.min("raw").alias("kept_raw")))
    return cut(texts.join(kept, "digest").mapInArrow(tidy(run), "digest binary, doc_id bigint"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``exact_groups`` of all documents."""
    return exact_groups(documents(spark, sf_dir))
