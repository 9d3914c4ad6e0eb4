"""Operator 9, n-gram Jaccard join by chosen paths.

A repeat is a random tree whose nodes are paths of shingles. A set goes from a node to
the children of those of its shingles that the node's hash samples, each with
probability 1 / (RATE * size). Two sets at the threshold share a child more often than
not, sets far below it seldom. A bucket of few sets is compared by brute force; a larger
one is split further, to depth 3 and then 6; repeats are added until a pair at the
threshold meets at the last depth with the target recall. Buckets that are still large
at the last depth hold sets that are really alike, or many copies of a passage; they
are resolved exactly by ``links``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import links
from corpusloom.llm.blocks import U, buffers, mix, slices
from corpusloom.llm.runtime import cut, documents, tidy, unpacked, whole_number, whole_row

THRESHOLD = 0.8
RECALL = 0.9999
RATE = 0.7
DEPTHS = (1, 3, 6)
SALT = U(0x8CB92BA72F3D8DD7)


def survival(threshold: float, depth: int, rate: float = RATE) -> float:
    """Least probability that two sets at ``threshold`` share a path of ``depth`` in one repeat.

    They share at least ``threshold`` of the larger set; the shared children of a shared
    node are close to Poisson with mean threshold / rate.
    """
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-threshold / rate * q)
    return q


def repeats(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTHS[-1]) -> int:
    """Repeats after which such a pair has met with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survival(threshold, depth))))


def enough(count: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """First nodes outside of large buckets that suffice for a set in ``count`` repeats.

    A first node of one set misses a set at the threshold if its shingle is absent there or not
    sampled. At most a share of 1 - threshold is, so the misses are at most close to Poisson; as
    many as this among them are less likely than 1 - ``recall``.
    """
    mean = count * (1 - threshold) / RATE
    term = total = math.exp(-mean)
    k = 0
    while 1 - total > 1 - recall:
        k += 1
        term *= mean / k
        total += term
    return k + 1


def limits(sizes: np.ndarray) -> np.ndarray:
    """Hashes below this sample a shingle of a set of the given size."""
    return np.minimum(2.0**64 / (RATE * np.maximum(sizes, 1)), 2.0**64 - 2048).astype(np.uint64)


def roots(values: np.ndarray, rows: np.ndarray, count: int) -> list[np.ndarray]:
    """The first nodes of each set in ``count`` repeats."""
    n = len(rows) - 1
    sizes = np.diff(rows)
    limit = np.repeat(limits(sizes), sizes)
    owner = np.repeat(np.arange(n), sizes)
    nodes, owners = [], []
    for r in range(count):
        seed = mix(np.array([r + 1], dtype=np.uint64) ^ SALT)[0]
        hit = np.flatnonzero(values * (seed | U(1)) < limit)
        nodes.append(mix(values[hit] ^ seed))
        owners.append(owner[hit])
    nodes, owners = np.concatenate(nodes), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    at = np.searchsorted(owners[order], np.arange(n + 1))
    found = nodes[order].view(np.int64)
    return [found[at[i] : at[i + 1]] for i in range(n)]


def extend(values: np.ndarray, paths: np.ndarray, limit: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The children of each node for one set, and the index of each child's parent."""
    parents, nodes = [], []
    for begin in range(0, len(paths), 64):
        part = paths[begin : begin + 64]
        hashed = mix(values[None, :] ^ part[:, None])
        a, b = np.nonzero(hashed < limit)
        parents.append(a + begin)
        nodes.append(mix(hashed[a, b] ^ part[a] ^ SALT))
    return (np.concatenate(nodes), np.concatenate(parents)) if nodes else (paths, np.zeros(0, np.int64))


def descend(values: np.ndarray, start: np.ndarray) -> list[tuple[int, int | None]]:
    """All (node at the second depth, node at the third or None) below the given first nodes."""
    limit = limits(np.array([len(values)]))[0]
    nodes = start.view(np.uint64)
    for _ in range(DEPTHS[1] - DEPTHS[0]):
        nodes, _ = extend(values, nodes, limit)
    middle, origin = nodes, np.arange(len(nodes))
    for _ in range(DEPTHS[2] - DEPTHS[1]):
        nodes, parents = extend(values, nodes, limit)
        origin = origin[parents]
    out: list[tuple[int, int | None]] = [(int(middle.view(np.int64)[o]), int(x)) for o, x in zip(origin, nodes.view(np.int64))]
    alive = set(origin.tolist())
    return out + [(int(x), None) for o, x in enumerate(middle.view(np.int64)) if o not in alive]


def split_further(docs: DataFrame):
    """How ``links.resolve`` splits buckets of the first depth that are too large."""

    def deeper(large: DataFrame, one: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        lists = large.groupBy("node").agg(F.collect_set("bucket").alias("start"))
        wide = links.with_text(lists.join(one.select("node", "doc_id", "set_key"), "node"), docs).select("node", "set_key", "start", "text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = buffers(batch.column("text"))
                ids, starts = batch.column("node").to_pylist(), batch.column("start").to_pylist()
                for first, last in slices(offsets):
                    values, rows = links.unique_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                    out: list[tuple] = []
                    for k in range(first, last):
                        own = values[rows[k - first] : rows[k - first + 1]]
                        out += [(ids[k], *x) for x in descend(own, np.array(sorted(starts[k]), dtype=np.int64))]
                    if out:
                        a, b, c = zip(*out)
                        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], ["node", "middle", "last"])

        paths = cut(wide.mapInArrow(tidy(run), "node bigint, middle bigint, last bigint").distinct())
        small, middle, large = links.split_by_size(paths.select("node", F.col("middle").alias("bucket")).distinct())
        if large.isEmpty():
            return small, middle, large
        rest = large.select("node", F.col("bucket").alias("middle")).join(paths.where("last is not null"), ["node", "middle"])
        more, some, large = links.split_by_size(rest.select("node", F.col("last").alias("bucket")).distinct())
        return small.unionByName(more), middle.unionByName(some), large

    return deeper


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Documents whose sets of five-word shingles have a Jaccard similarity of ``threshold`` or more.

    Returned and defined as by ``links.resolve``: doc_id, class_id, n_links, set_id. Each
    reported link is exact; a pair at the threshold is found with probability ``recall``
    or more, equal sets always. An empty table gives an empty result.
    """
    half = 1 - (1 - recall) / 2  # each of the two ways to miss a pair has half of what is allowed
    count = repeats(threshold, half)
    return links.resolve(docs, lambda values, rows: roots(values, rows, count), threshold, split_further(docs), enough(count, threshold, half))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each linked class: the one with the smallest doc_id.

    Rows that repeat both doc_id and text give one row; a row without doc_id stays. Null, empty
    and blank texts have no links and stay. An empty table gives an empty result; other columns
    are kept under any names.
    """
    classes = jaccard_join(docs, threshold)
    kept = cut(classes.where("doc_id = class_id").select(F.col("doc_id").alias("_id")).distinct())
    held = docs.select(whole_number("doc_id").alias("_id"), F.col("text").alias("_text"), whole_row(docs).alias("row"))
    rows = held.where("_id is not null").join(kept, "_id", "left_semi")
    once = Window.partitionBy("_id", "_text").orderBy(F.lit(1))
    rows = rows.withColumn("_once", F.row_number().over(once)).where("_once = 1").select("row")
    return unpacked(rows, docs.columns).unionByName(docs.where("doc_id is null"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``jaccard_join`` of all documents, with production parameters."""
    return jaccard_join(documents(spark, sf_dir))
