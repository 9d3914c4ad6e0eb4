"""From buckets of documents that may be alike to exact links, their counts and classes.

The way is the same for every kind of bucket:

1. Documents with equal shingle sets become one node with a weight.
2. Nodes of a bucket of at most SMALL nodes are paired, and pairs whose sketches rule out
   the threshold are dropped. What passes is a tight edge. One task compares all sketches of
   a bucket of up to BLOCK nodes and gives a spanning forest of its tight edges.
3. In a larger bucket every node is compared with the centre, one of the nodes whose sketches
   begin as most do there, so that a large group of near copies meets one of its own. Those
   very like it (``leaves``) are joined to it and leave the bucket with it. By the triangle
   inequality of sketches, whatever is tight to one that leaves is at least ``joins`` like
   the centre; such nodes are compared with all that leave, and stay in the bucket too. So no
   tight pair is lost. Rounds go on while they take a fair share (ROUND) of what is large; what
   stays large is compared block by block.
4. All nodes of a connected group of tight edges are verified exactly by a matrix product of
   incidence: a node's set goes to its group once for each other block in a group of over
   BLOCK nodes or BLOCK_SHINGLES shingles.

No step emits pairs of a large group: tasks give spanning forests, counts and edges to a
centre. Aggregates are materialised before they are joined, since Spark splits the join of a
very common key only between two plain shuffles.

A pair at the threshold that meets in a bucket is missed only if its sketches differ from
it by five standard deviations (SLACK), about three in ten million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.blocks import MinHash, U, buffers, mix, shingles, slices, words
from corpusloom.llm.runtime import BROADCAST_ROWS, cut, fitting, parts, small_side, tidy, whole_number

SMALL = 32
BLOCK = 512
BLOCK_SHINGLES = 400_000
SKETCH = 64
#: Less than the threshold by more than this in shares of equal sketch values rules out the threshold: five standard deviations.
SLACK = 0.25
#: In a large bucket, a node that shares this much of the centre's sketch leaves with it.
LEAVES = 0.75
#: Sketch values by which the most frequent kind of node in a large bucket is found.
KIND = 4
#: The least share of the nodes in large buckets that leaves in a round which is followed by another.
ROUND = 0.1
#: Edges that one task contracts.
EDGES = 200_000
#: Most sketches (SKETCH bytes each) that are broadcast.
SKETCH_ROWS = 50_000


def tight(threshold: float) -> float:
    """The least share of equal sketch values that leaves ``threshold`` possible."""
    return int(np.floor((threshold - SLACK) * SKETCH)) / SKETCH


def joins(threshold: float) -> float:
    """The least share with the centre of whatever is tight to one that leaves with it."""
    return max(0.0, LEAVES + tight(threshold) - 1)


Keys = Callable[[np.ndarray, np.ndarray], list[np.ndarray]]


def band_keys(signature: np.ndarray, bands: int, width: int) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    part = signature[: bands * width].astype(np.uint64).reshape(bands, width)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(width):
        key = mix((key << U(1)) ^ part[:, k] ^ (key >> U(7)))
    return key.view(np.int64)


def unique_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each row, one after another, and the rows' offsets."""
    values, rows = shingles(*words(data, offsets))
    sets = [np.unique(values[rows[i] : rows[i + 1]]) for i in range(len(rows) - 1)]
    return (np.concatenate(sets) if sets else values), np.concatenate([[0], np.cumsum([len(x) for x in sets], dtype=np.int64)])


def nodes(docs: DataFrame, keys: Keys) -> tuple[DataFrame, DataFrame]:
    """All documents (doc_id, set_key), and one node for each distinct set with a word.

    Nodes: node, doc_id (smallest), set_key, weight (documents), size, sketch, keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = MinHash(SKETCH, seed=7)
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            ids = batch.column("doc_id")
            for first, last in slices(offsets):
                values, rows = unique_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                marks = sketcher.signatures(values, rows).astype(np.uint8)
                found = keys(values, rows)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": ids.slice(first, last - first),
                        "set_key": pa.array([hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(rows[:-1], rows[1:])], pa.binary()),
                        "size": pa.array(np.diff(rows), pa.int64()),
                        "sketch": pa.array([x.tobytes() for x in marks], pa.binary()),
                        "keys": pa.array(found, pa.list_(pa.int64())),
                    }
                )

    rows = docs.select(whole_number("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    done = cut(rows.mapInArrow(tidy(run), "doc_id bigint, set_key binary, size bigint, sketch binary, keys array<bigint>"))
    one = done.where("size > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("weight"), F.first(F.struct("size", "sketch", "keys")).alias("x")
    )
    one = cut(one.select("set_key", "doc_id", "weight", "x.*").withColumn("node", F.monotonically_increasing_id()))
    return done.select("doc_id", "set_key"), one


def split_by_size(members: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of ``members`` (bucket, node and others) in buckets with 2 to SMALL nodes, up to BLOCK, and in larger ones, materialised."""
    counts = cut(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    buckets, rows = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    sized = cut(fitting(members.join(small_side(counts, buckets), "bucket"), rows))
    return tuple(sized.where(c).drop("n") for c in (F.col("n") <= SMALL, F.col("n").between(SMALL + 1, BLOCK), F.col("n") > BLOCK))


def small_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs (u, v), u < v, of nodes that share a bucket of at most SMALL nodes."""
    lists = members.groupBy("bucket").agg(F.sort_array(F.collect_set("node")).alias("m")).select("m").distinct()
    first = lists.select("m", F.posexplode("m").alias("i", "u"))
    return first.select("u", F.explode(F.expr("slice(m, i + 2, size(m))")).alias("v")).where("u < v").distinct()


def equal_values(x: pa.Array, y: pa.Array) -> np.ndarray:
    """How many sketch values are equal, for each row."""
    a, b = (buffers(c.cast(pa.large_binary()))[0].reshape(-1, SKETCH) for c in (x, y))
    return (a == b).sum(axis=1)


def scored(pairs: DataFrame, one: DataFrame, least: float) -> DataFrame:
    """``pairs`` (u, v) with ``same``, the share of equal sketch values, where that is ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = equal_values(batch.column("a"), batch.column("b")) / SKETCH
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(same)], ["u", "v", "same"]).filter(pa.array(same >= least))

    a = one.select(F.col("node").alias("u"), F.col("sketch").alias("a"))
    b = one.select(F.col("node").alias("v"), F.col("sketch").alias("b"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(tidy(run), "u bigint, v bigint, same double")


def tight_pairs(small: DataFrame, one: DataFrame, threshold: float) -> DataFrame:
    """The tight edges (u, v) in buckets of at most SMALL nodes."""
    return scored(small_pairs(small), one, tight(threshold)).select("u", "v")


def by_size(members: DataFrame, threshold: float) -> DataFrame:
    """Buckets (bucket, node, size and others) split by the sets' sizes without loss.

    Sets at the threshold differ in size by its inverse at most. Classes are that wide, and a
    set is put in its own and the next one, so such sets share one.
    """
    own = F.floor(F.log(F.col("size").cast("double")) / float(-np.log(threshold)) + 1e-9)
    classes = members.withColumn("class", F.explode(F.array(own, own + 1)))
    return classes.withColumn("bucket", F.xxhash64("bucket", "class")).drop("class")


def strip(left: DataFrame, one: DataFrame, threshold: float) -> tuple[list[DataFrame], DataFrame]:
    """One round over buckets (bucket, node, size, sketch): tight edges (u, v) of what leaves, and the buckets without it."""
    kinds = left.groupBy("bucket", F.substring("sketch", 1, KIND).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "sketch")).alias("c"))
    most = kinds.groupBy("bucket").agg(F.max_by("c", F.struct("n", "c.node")).alias("c"))
    centres = cut(most.select("bucket", F.col("c.node").alias("u"), F.col("c.sketch").alias("a")))
    few = F.broadcast(centres) if centres.count() <= SKETCH_ROWS else centres
    star = left.join(few, "bucket").where("node <> u").select("bucket", "u", "a", "node", "size", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "u", "node", "size", "sketch"]
        for batch in batches:
            same = equal_values(batch.column("a"), batch.column("sketch")) / SKETCH
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(same)], [*names, "same"])

    alike = cut(star.mapInArrow(tidy(run), "bucket bigint, u bigint, node bigint, size bigint, sketch binary, same double"))
    pairs = alike.select("u", F.col("node").alias("v"), "same")
    edges = [pairs.where(F.col("same") >= tight(threshold)).select("u", "v")]
    gone, others = pairs.where(F.col("same") >= LEAVES), pairs.where((F.col("same") >= joins(threshold)) & (F.col("same") < tight(threshold)))
    if not others.isEmpty() and not gone.isEmpty():
        edges.append(beside(gone.select("u", "v").distinct(), others.select("u", "v").distinct(), one, threshold))
    return edges, alike.where(F.col("same") < LEAVES).select("bucket", "node", "size", "sketch")


def rounds(large: DataFrame, one: DataFrame, threshold: float) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame], DataFrame]:
    """``strip`` of large buckets (bucket, node, size, sketch) while it takes a fair share: edges, what is left as small, as middle and as large ones."""
    edges, small, middle = [], [], []
    while not large.isEmpty():
        found, rest = strip(large, one, threshold)
        edges += found
        ends = rest.count() > (1 - ROUND) * large.count()
        fewer, some, large = split_by_size(rest)
        small.append(fewer)
        middle.append(some)
        if ends:
            break
    return edges, small, middle, large


def beside(gone: DataFrame, others: DataFrame, one: DataFrame, threshold: float) -> DataFrame:
    """Edges (u, v) of the ``others`` (u, v) that are tight to one of ``gone`` (u, v) with the same centre u."""
    many = gone.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    sizes = cut(many.join(others.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / (8 * BLOCK)).alias("shares")), "u"))

    def numbers(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    def own(n: str) -> F.Column:
        return F.pmod(F.xxhash64("v"), F.col(n))

    both = [
        gone.join(small_side(sizes), "u").select("u", "v", own("blocks").alias("i"), numbers("shares").alias("j"), F.lit(0).alias("side")),
        others.join(small_side(sizes), "u").select("u", "v", numbers("blocks").alias("i"), own("shares").alias("j"), F.lit(1).alias("side")),
    ]
    dealt = both[0].union(both[1]).join(one.select(F.col("node").alias("v"), "sketch"), "v").select("u", "i", "j", "side", "v", "sketch")
    least = round(tight(threshold) * SKETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            found: list[tuple[int, int]] = []
            for u, i, j, side, v, sketch in zip(*(batch.column(c).to_pylist() for c in ("u", "i", "j", "side", "v", "sketch"))):
                if (u, i, j) != key:
                    key, held = (u, i, j), []
                mark = np.frombuffer(sketch, np.uint8)
                if not side:
                    held.append(mark)
                    continue
                if isinstance(held, list):
                    held = np.array(held, dtype=np.uint8).reshape(-1, SKETCH)
                if ((held == mark).sum(axis=1) >= least).any():
                    found.append((u, v))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])

    n = parts(one.sparkSession)
    return dealt.repartition(n, "u", "i", "j").sortWithinPartitions("u", "i", "j", "side").mapInArrow(tidy(run), "u bigint, v bigint")


def block_edges(left: DataFrame, threshold: float) -> DataFrame:
    """Edges (u, v) that connect what is tight in large buckets: a spanning forest for each pair of blocks."""
    sizes = cut(left.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")))
    placed = left.join(small_side(sizes), "bucket").withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    single = placed.where("blocks = 1").select("bucket", "own", F.col("own").alias("j"), "node", "sketch")
    dealt = placed.where("blocks > 1").withColumn("p", block_pairs()).select("bucket", "p.i", "p.j", "node", "sketch").union(single)
    least = round(tight(threshold) * SKETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            found: list[tuple[int, int]] = []
            for bucket, i, j, node, sketch in zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j", "node", "sketch"))):
                if (bucket, i, j) != key:
                    found += forest(held, least)
                    key, held = (bucket, i, j), []
                held.append((node, sketch))
            if found:
                yield table(found)
        if found := forest(held, least):
            yield table(found)

    def table(found: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])

    n = parts(left.sparkSession)
    return dealt.repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(tidy(run), "u bigint, v bigint")


def block_pairs() -> F.Column:
    """The pairs of blocks (i, j), i <= j, that a row of the block ``own`` of ``blocks`` takes part in."""
    pairs = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    return F.explode(pairs)


def smallest_linked(linked: np.ndarray) -> np.ndarray:
    """The smallest index that each index is connected with in a symmetric matrix of links."""
    n = len(linked)
    label = np.arange(n)
    while True:
        new = label.copy()
        for begin in range(0, n, 256):
            new[begin : begin + 256] = np.minimum(label[begin : begin + 256], np.where(linked[begin : begin + 256], label, n).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def forest(held: list[tuple[int, bytes]], least: int) -> list[tuple[int, int]]:
    """Edges (smallest node, node) that connect the nodes of two blocks whose sketches share ``least`` values."""
    if len(held) < 2:
        return []
    held = sorted(held)
    marks = np.frombuffer(b"".join(x[1] for x in held), np.uint8).reshape(-1, SKETCH)
    same = np.zeros((len(held), len(held)), dtype=np.uint8)
    for k in range(SKETCH):
        same += marks[:, k, None] == marks[None, :, k]
    label = smallest_linked(same >= least)
    return [(held[a][0], held[k][0]) for k, a in enumerate(label.tolist()) if a != k]


def packed(df: DataFrame, few: int) -> DataFrame:
    """``df`` materialised in ``few`` partitions if that is fewer than a shuffle makes."""
    return cut(df.coalesce(few) if few < parts(df.sparkSession) else df)


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) for the nodes of one task's edges (u, v), by union and find."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if parent:
        ids = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([find(x) for x in ids], pa.int64())], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge: root is the smallest node that it is connected with.

    Tasks of up to EDGES edges contract theirs; what is left of several tasks is joined by
    alternating large and small stars, whose rounds grow with the logarithm of the longest path.
    """
    now = cut(edges.select("u", "v").where("u <> v"))
    few = max(1, -(-now.count() // EDGES))
    own = cut(now.coalesce(few).mapInArrow(tidy(contracted), "node bigint, root bigint"))
    if few == 1:
        return own
    now = cut(own.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")).distinct())
    while True:
        both = now.union(now.select("v", "u"))
        least = packed(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), few)
        large = both.join(small_side(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = packed(large, few)  # u > v throughout
        least = packed(down.groupBy("u").agg(F.min("v").alias("m")), few)
        small = down.join(small_side(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = packed(small.union(least.select("u", F.col("m").alias("v"))).distinct(), few)
        single = now.groupBy("u").count().where("count > 1").isEmpty()
        if single and now.select("v").distinct().join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break  # each node has one root, and no root has another
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())


def with_text(chosen: DataFrame, docs: DataFrame) -> DataFrame:
    """``chosen`` (doc_id, set_key and others) with a ``text`` of each: that of its doc_id, or one with its set where doc_id is null."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for first, last in slices(offsets):
                values, rows = unique_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                found = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(rows[:-1], rows[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column("text").slice(first, last - first)], ["set_key", "text"])

    chosen = cut(chosen)
    texts = docs.select(whole_number("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = cut(chosen.where("doc_id is not null").select("doc_id").distinct())
    if ids.count() <= BROADCAST_ROWS:  # then the other texts needn't move
        texts = texts.join(F.broadcast(ids), "doc_id", "left_semi").unionByName(texts.where("doc_id is null"))
    nameless = texts.where("doc_id is null").select("text").mapInArrow(tidy(keyed), "set_key binary, text string").dropDuplicates(["set_key"])
    return chosen.join(texts, "doc_id").unionByName(chosen.where("doc_id is null").join(nameless, "set_key"))


def verified(groups: DataFrame, docs: DataFrame, one: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) from the exact comparison of all nodes of each group (node, root)."""
    spark = docs.sparkSession
    sized = cut(groups.join(one.select("node", "doc_id", "set_key", "weight", "size"), "node"))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_SHINGLES))
    placed = sized.join(small_side(cut(sized.groupBy("root").agg(blocks.alias("blocks")))), "root")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            rest = batch.drop_columns(["text", "set_key"])
            given = batch.column("set_key").to_pylist()
            for first, last in slices(offsets):
                values, rows = unique_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                raw = [values[a:b].tobytes() for a, b in zip(rows[:-1], rows[1:])]
                same = pa.array([hashlib.blake2b(x, digest_size=16).digest() == y for x, y in zip(raw, given[first:last])])
                part = rest.slice(first, last - first).append_column("set", pa.array(raw, pa.binary()))
                yield part.filter(same)

    with_sets = with_text(placed, docs).select("node", "root", "blocks", "own", "weight", "set_key", "text")
    with_sets = with_sets.mapInArrow(tidy(sets), "node bigint, root bigint, blocks bigint, own bigint, weight bigint, set binary")
    dealt = with_sets.withColumn("p", block_pairs()).select("node", "own", "weight", "set", "root", "p.i", "p.j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        key = None
        done: list[tuple] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("root", "i", "j", "node", "own", "weight", "set")]
            for root, i, j, node, own, weight, raw in zip(*columns):
                if (root, i, j) != key:
                    done += compared(held, key, threshold)
                    held, key = {}, (root, i, j)
                held[node] = (own, weight, np.frombuffer(raw, np.uint64))  # rows that repeat an id give one node
                if len(done) >= 20_000:
                    yield table(done)
                    done = []
        done += compared(held, key, threshold)
        if done:
            yield table(done)

    def table(done: list[tuple]) -> pa.RecordBatch:
        a, b, c = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], ["node", "links", "root"])

    n = parts(spark)
    return dealt.repartition(n, "root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(tidy(compare), "node bigint, links bigint, root bigint")


def compared(held: dict[int, tuple], key: tuple | None, threshold: float) -> list[tuple]:
    """(node, linked weight, smallest linked node) for one pair of blocks of a group."""
    if len(held) < 2:
        return []
    ids = np.array(sorted(held))
    own = np.array([held[x][0] for x in ids])
    weight = np.array([held[x][1] for x in ids], dtype=np.float64)
    sets = [held[x][2] for x in ids]
    size = np.array([len(x) for x in sets], dtype=np.float64)
    _, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    renamed = np.cumsum(shared) - 1
    row = np.repeat(np.arange(len(sets)), size.astype(np.int64))
    keep = shared[place]
    row, column = row[keep], renamed[place[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)  # whole numbers below 2**24 are exact
    width, total = 2048, int(shared.sum())
    for begin in range(0, total, width):
        a, b = np.searchsorted(column, [begin, begin + width])
        part = np.zeros((len(sets), min(width, total - begin)), dtype=np.float32)
        part[row[a:b], column[a:b] - begin] = 1
        common += part @ part.T
    linked = common / np.maximum(size[:, None] + size[None, :] - common, 1) >= threshold
    np.fill_diagonal(linked, False)
    _, i, j = key
    if i != j:
        linked &= own[:, None] != own[None, :]
    label = smallest_linked(linked)
    count = (linked @ weight).astype(np.int64)
    return [(int(ids[k]), int(count[k]), int(ids[label[k]])) for k in range(len(ids)) if count[k]]


def resolve(docs: DataFrame, keys: Keys, threshold: float, deeper: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] | None = None, enough: int = 0) -> DataFrame:
    """One row for each document: doc_id, class_id, n_links, set_id.

    ``keys`` gives the buckets of each set. ``deeper`` splits buckets of over BLOCK nodes
    and returns new ones by size; only nodes in fewer than ``enough`` buckets of at most SMALL
    nodes need larger ones, the others' links are found in these. class_id is the smallest doc_id of the documents
    that links connect, set_id of those with the same set; n_links counts the other
    documents at ``threshold`` or above. Null or empty texts, and texts without a word,
    have no links and their own class; rows that repeat a doc_id each get a row.
    """
    everyone, one = nodes(docs, keys)
    marks = one.select("node", "size", "sketch")
    small, middle, large = split_by_size(one.select("node", F.explode(F.array_distinct("keys")).alias("bucket")))
    edges: list[DataFrame] = []
    blocks = [middle.join(marks, "node")]
    beyond = middle.unionByName(large)
    if deeper is not None and not beyond.isEmpty():
        own = beyond.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))
        needy = one.join(own, "node").where(F.size(F.array_distinct("keys")) - F.size("buckets") < enough)
        fewer, middle, large = split_by_size(needy.select(F.explode("buckets").alias("bucket"), "node", "size", "sketch"))
        small, blocks = small.unionByName(fewer.select("bucket", "node")), [middle]
        if not large.isEmpty():
            found, rest = strip(large, one, threshold)
            edges += found  # groups of near copies needn't be split further
            fewer, middle, large = split_by_size(by_size(rest, threshold))
            small = small.unionByName(fewer.select("bucket", "node"))
            blocks.append(middle)
            found, fewer, middle, large = rounds(large, one, threshold)
            edges += found
            for more in fewer:
                small = small.unionByName(more.select("bucket", "node"))
            blocks += middle
            large = large.select("bucket", "node")
        if not large.isEmpty():
            more, middle, large = deeper(large, one)
            small = small.unionByName(more)
            blocks.append(middle.distinct().join(marks, "node"))
    if not large.isEmpty():
        found, fewer, middle, large = rounds(cut(large.select("bucket", "node").distinct().join(marks, "node")), one, threshold)
        for more in fewer:
            small = small.unionByName(more.select("bucket", "node"))
        blocks += [*middle, large]
        edges += found
    for more in blocks[1:]:
        blocks[0] = blocks[0].unionByName(more)
    if not blocks[0].isEmpty():
        edges.append(block_edges(cut(blocks[0].select("bucket", "node", "sketch")), threshold))
    for more in edges[1:]:
        edges[0] = edges[0].union(more)
    near = tight_pairs(small, one, threshold)
    edges = near.union(edges[0]) if edges else near
    groups = cut(components(edges))
    exact = cut(verified(groups, docs, one, threshold))
    counts = exact.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(exact.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    full = one.select("node", "set_key", "doc_id", "weight").join(counts, "node", "left").join(roots, "node", "left")
    full = cut(full.withColumn("root", F.coalesce("root", "node")))
    least = cut(full.groupBy("root").agg(F.min("doc_id").alias("class_id")))
    classes = full.join(least, "root").select(
        "set_key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.col("doc_id").alias("set_id")
    )
    return everyone.join(classes, "set_key", "left").select(
        "doc_id",
        F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("set_id")).alias("set_id"),
    )
