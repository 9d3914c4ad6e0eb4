"""Operator 12, the prefix trie of conversations, by an LCP-aware external mergesort.

A conversation is the sequence of its turns' digests. Sorted runs carry with every sequence
the number of turns it shares with the one before (its LCP). They are written to the shared
folder and dealt out by ranges of sequences, so that neither a common beginning nor many
copies of one conversation meet in a task. Each task merges its parts of the runs by a loser
tree that compares LCPs first and turns only where these are equal, from there on. The merged
stream drives a stack of the nodes on the open path: what the next sequence doesn't share is
finished, and adds its sums to the node above.

Only the nodes on the paths of a task's first and last sequence can go on in other tasks.
They are left open, two paths a task, and the same stack goes over them in the order of the
ranges. The ids of conversations that end in such a node are hashed piece by piece.

A conversation's digests (20 bytes a turn) are one value, so it may have some 100 million
turns; its texts are never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.blocks import buffers
from corpusloom.llm.runtime import BROADCAST_ROWS, cut, documents, parts, stored, tidy, whole_number

#: Bytes of a turn's digest.
TURN = 16
#: Conversations and bytes after which a run is sorted and written.
RUN, RUN_BYTES = 20_000, 1 << 25
#: Conversations that share a base, and the most turns they take from it.
FAMILY, HEAD = 20, 3
#: Conversation ids in a piece of those that end in an open node.
PIECE = 4096
SALTS = 16
_COUNTS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
_NUMBERS = ("kind", "conv_id", "depth", "parent_conv_id", *_COUNTS, "part", "at", "words")
_BINARY = ("above", "path", "ends")
NODES = pa.schema([*((x, pa.int64()) for x in _NUMBERS), *((x, pa.binary()) for x in _BINARY), ("ids", pa.string())])
NODES_SQL = ", ".join([*(f"{x} bigint" for x in _NUMBERS), *(f"{x} binary" for x in _BINARY), "ids string"])
DONE, OPEN, ENDS = range(3)


def crc(column: Column) -> Column:
    return F.crc32(column.cast("string").cast("binary"))


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, digests, words: every conversation of ``turns`` (conv_id, turn, role, text) in the order of its turns.

    Null turns come first; ties go by role and digest, repeated rows are turns of their own.
    Null role and text count as empty. Rows without conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("int")
    rows = turns.select(whole_number("conv_id").alias("conv_id"), whole_number("turn").alias("turn"), role.alias("role"), digest.alias("digest"), words.alias("words"))
    lists = rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "words"))).alias("turns"))
    return lists.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.words").alias("words"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """The sequences, each with its first crc32(conv_id) % 4 turns taken from conversation conv_id - conv_id % 20."""
    bases = turns.where(whole_number("conv_id") % FAMILY == 0)
    heads = sequences(bases).select(F.col("conv_id").alias("base"), *(F.slice(x, 1, HEAD).alias(f"head_{x}") for x in ("digests", "words")))
    own = sequences(turns).withColumn("h", (crc(F.col("conv_id")) % (HEAD + 1)).cast("int"))
    both = own.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("base"), "left")

    def spliced(name: str, kind: str) -> Column:
        head = F.coalesce(F.col(f"head_{name}"), F.array().cast(kind))
        return F.concat(F.slice(head, F.lit(1), F.col("h")), F.slice(name, F.col("h") + 1, F.size(name))).alias(name)

    return both.select("conv_id", spliced("digests", "array<binary>"), spliced("words", "array<int>"))


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Number of turns that two sequences begin with alike, ``known`` of which are known to be."""
    most = min(len(a), len(b)) // TURN
    while known < most and a[known * TURN : known * TURN + TURN] == b[known * TURN : known * TURN + TURN]:
        known += 1
    return known


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs with the LCP of each sequence and the one before."""
    number, rows, size = TaskContext.get().partitionId() << 32, [], 0

    def run() -> pa.RecordBatch:
        rows.sort(key=lambda x: (x[1], x[0]))
        lcps = [0, *(shared(a[1], b[1]) for a, b in zip(rows, rows[1:]))]
        columns = [[number] * len(rows), range(len(rows)), lcps, *zip(*rows)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    schema = pa.schema([("run", pa.int64()), ("at", pa.int64()), ("lcp", pa.int64()), ("conv_id", pa.int64()), ("key", pa.binary()), ("words", pa.binary())])
    for batch in batches:
        lists = batch.column("digests")
        keys = buffers(lists.flatten())[0].tobytes() if len(lists.flatten()) else b""
        counts = batch.column("words").flatten().to_numpy(zero_copy_only=False).astype("<i4").tobytes()
        at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).tolist()
        for k, conv_id in enumerate(batch.column("conv_id").to_pylist()):
            rows.append((conv_id, keys[TURN * at[k] : TURN * at[k + 1]], counts[4 * at[k] : 4 * at[k + 1]]))
            size += (TURN + 4) * (at[k + 1] - at[k]) + 8
            if len(rows) >= RUN or size >= RUN_BYTES:
                yield run()
                number, rows, size = number + 1, [], 0
    if rows:
        yield run()


class LoserTree:
    """Merges sorted runs of (key, conv_id, words, LCP with the one before) and gives each item's LCP with the last one given.

    All heads know how many turns they share with the last winner. Of two, the one that shares
    more is less; only equals are compared, from there on, and what they share then holds
    between the loser and the winner that went past it.
    """

    def __init__(self, runs: list[list[tuple[bytes, int, bytes, int]]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.lcps = [0] * len(runs)
        self.width = 1 << max(0, (len(runs) - 1).bit_length())
        self.losers = [-1] * self.width
        winners = [k if k < len(runs) else -1 for k in range(self.width)]
        level = self.width
        while level > 1:
            level //= 2
            played = [self.play(winners[2 * k], winners[2 * k + 1]) for k in range(level)]
            self.losers[level : 2 * level] = [x[1] for x in played]
            winners = [x[0] for x in played]
        self.winner = winners[0]

    def play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs' heads; an absent or exhausted run loses."""
        if b < 0 or self.at[b] == len(self.runs[b]):
            return a, b
        if a < 0 or self.at[a] == len(self.runs[a]):
            return b, a
        if self.lcps[a] != self.lcps[b]:
            return (a, b) if self.lcps[a] > self.lcps[b] else (b, a)
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        both = shared(x[0], y[0], self.lcps[a])
        won, lost = (a, b) if (x[0][both * TURN : both * TURN + TURN], x[1]) < (y[0][both * TURN : both * TURN + TURN], y[1]) else (b, a)
        self.lcps[lost] = both
        return won, lost

    def __iter__(self) -> Iterator[tuple[bytes, int, bytes, int]]:
        while self.winner >= 0 and self.at[self.winner] < len(self.runs[self.winner]):
            k = self.winner
            key, conv_id, words, _ = self.runs[k][self.at[k]]
            yield key, conv_id, words, self.lcps[k]
            self.at[k] += 1
            if self.at[k] < len(self.runs[k]):
                self.lcps[k] = self.runs[k][self.at[k]][3]
            node = (self.width + k) // 2
            while node:
                k, self.losers[node] = self.play(k, self.losers[node])
                node //= 2
            self.winner = k


class Node:
    __slots__ = ("depth", "above", "words", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "open", "path")

    def __init__(self, depth: int, above: Node | None, words: int, path: bytes | None = None):
        self.depth, self.above, self.words, self.path = depth, above, words, path
        self.conv_id: int | None = None
        self.n_convs = self.n_children = self.n_leaves = self.saved_tokens = 0
        self.ends: list[int] = []
        self.open = False

    def gather(self, other: Node) -> None:
        """Add what is known of another part of the same node, or of a finished child."""
        self.n_convs += other.n_convs
        self.n_leaves += other.n_leaves
        self.saved_tokens += other.saved_tokens
        if self.conv_id is None or other.conv_id is not None and other.conv_id < self.conv_id:
            self.conv_id = other.conv_id

    def finish(self) -> None:
        """Close the sums over the subtree and add them to the node above."""
        self.n_leaves += self.n_children == 0
        self.saved_tokens += (self.n_convs - 1) * self.words
        if self.above is not None:
            self.above.n_children += 1
            self.above.gather(self)


def nodes_of(items: Iterator[tuple[bytes, int, bytes, int]]) -> list[Node]:
    """The nodes of sorted sequences, in preorder; those on the first and the last path stay open."""
    nodes: list[Node] = []
    stack: list[Node] = []
    first = True
    for key, conv_id, words, lcp in items:
        if first:
            stack.append(root := Node(0, None, 0))
            nodes.append(root)
        while len(stack) > lcp + 1:
            node = stack.pop()
            if not node.open:
                node.finish()
        counts = np.frombuffer(words, "<i4")
        for depth in range(len(stack), len(key) // TURN + 1):
            node = Node(depth, stack[-1], int(counts[depth - 1]))
            nodes.append(node)
            stack.append(node)
        if first:
            for node in stack:
                node.open = True
            _mark(stack, key)
            first = False
        top = stack[-1]
        top.ends.append(conv_id)
        top.n_convs += 1
        top.conv_id = conv_id if top.conv_id is None else min(top.conv_id, conv_id)
    if stack:
        for node in stack:
            node.open = True
        _mark(stack, key)
    return nodes


def _mark(stack: list[Node], key: bytes) -> None:
    """Name the nodes of an open path by digests of all turns down to them."""
    running = hashlib.blake2b(digest_size=16)
    for node in stack:
        if node.depth:
            running.update(key[(node.depth - 1) * TURN : node.depth * TURN])
        node.path = running.copy().digest()


def joined_ids(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def _blocks(rows: Iterator[dict], schema: pa.Schema, most: int = 8192) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a range of sequences, whose rows come run by run."""
    runs: list[list[tuple[bytes, int, bytes, int]]] = []
    at = None
    for batch in batches:
        for run, lcp, conv_id, key, words in zip(*(batch.column(x).to_pylist() for x in ("run", "lcp", "conv_id", "key", "words"))):
            if run != at:
                at, lcp = run, 0  # the one before it in the run may be in another range
                runs.append([])
            runs[-1].append((key, conv_id, words, lcp))
    nodes = nodes_of(iter(LoserTree(runs))) if runs else []
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[dict]:
        for k, node in enumerate(nodes):
            row = {"conv_id": node.conv_id, "depth": node.depth} | {x: getattr(node, x) for x in _COUNTS}
            if node.open:
                yield row | {"kind": OPEN, "part": part, "at": k, "path": node.path, "words": node.words}
                for first in range(0, len(node.ends), PIECE):
                    yield {"kind": ENDS, "part": part, "at": first, "path": node.path, "ids": joined_ids(node.ends[first : first + PIECE])}
            else:
                above = {"above": node.above.path} if node.above.open else {"parent_conv_id": node.above.conv_id}
                yield row | above | {"kind": DONE, "ends": hashlib.sha256(joined_ids(node.ends).encode()).digest()}

    yield from _blocks(rows(), NODES)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The open nodes of all ranges, in their order, put together and finished."""

    def rows() -> Iterator[dict]:
        stack: list[Node] = []

        def pop() -> dict:
            node = stack.pop()
            node.finish()
            above = None if node.above is None else node.above.path
            return {"conv_id": node.conv_id, "depth": node.depth, "above": above, "path": node.path} | {x: getattr(node, x) for x in _COUNTS}

        for batch in batches:
            for x in batch.to_pylist():
                if len(stack) > x["depth"] and stack[x["depth"]].path != x["path"]:
                    while len(stack) > x["depth"]:
                        yield pop()
                if len(stack) == x["depth"]:
                    stack.append(Node(x["depth"], stack[-1] if stack else None, x["words"], x["path"]))
                node, part = stack[x["depth"]], Node(x["depth"], None, x["words"])
                part.conv_id, part.n_convs, part.n_leaves, part.saved_tokens = x["conv_id"], x["n_convs"], x["n_leaves"], x["saved_tokens"]
                node.n_children += x["n_children"]
                node.gather(part)
        while stack:
            yield pop()

    yield from _blocks(rows(), NODES)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each open node's ids, whose pieces come in order."""
    schema = pa.schema([("path", pa.binary()), ("ends", pa.binary())])

    def rows() -> Iterator[dict]:
        at = None
        for batch in batches:
            for path, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
                if path != at:
                    if at is not None:
                        yield {"path": at, "ends": running.digest()}
                    at, running = path, hashlib.sha256(ids.encode())
                else:
                    running.update(("," + ids).encode())
        if at is not None:
            yield {"path": at, "ends": running.digest()}

    yield from _blocks(rows(), schema)


def trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of ``sequences`` (conv_id, digests, words; conv_id unique and not null).

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. Equal sequences share all nodes; an empty sequence ends in the
    root; an empty table has no nodes.
    """
    n = parts(sequences.sparkSession)
    runs = stored(sequences.mapInArrow(tidy(_runs), "run bigint, at bigint, lcp bigint, conv_id bigint, key binary, words binary"), "runs")
    ranges = runs.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("run", "at")
    found = stored(ranges.mapInArrow(tidy(_merge), NODES_SQL), "nodes")
    out = ["conv_id", "depth", "parent_conv_id", *_COUNTS, "ends"]
    done = found.where(F.col("kind") == DONE)

    # two paths a range, whatever the number of conversations
    edges = found.where(F.col("kind") == OPEN).select("part", "at", "conv_id", "depth", "words", "path", *_COUNTS)
    closed = edges.repartition(1).sortWithinPartitions("part", "at").mapInArrow(tidy(_close), NODES_SQL).select("conv_id", "depth", "above", "path", *_COUNTS)
    pieces = found.where(F.col("kind") == ENDS).select("path", "part", "at", "ids").repartition(n, "path").sortWithinPartitions("path", "part", "at")
    closed = cut(closed.join(pieces.mapInArrow(tidy(_ends), "path binary, ends binary"), "path", "left").withColumn("ends", F.coalesce("ends", F.unhex(F.sha2(F.lit(""), 256)))))
    parents = closed.select(F.col("path").alias("up"), F.col("conv_id").alias("up_conv"))
    if parents.count() <= BROADCAST_ROWS:
        salt, parents = F.lit(0), F.broadcast(parents.withColumn("salt", F.lit(0)))
    else:  # a node may have a large share of all nodes below it
        salt, parents = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"), parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def below(rows: DataFrame) -> DataFrame:
        met = rows.where(F.col("above").isNotNull()).drop("parent_conv_id").withColumn("_salt", salt)
        return met.join(parents, (F.col("above") == F.col("up")) & (F.col("_salt") == F.col("salt"))).withColumn("parent_conv_id", F.col("up_conv")).select(*out)

    closed = closed.withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    inner = [rows.where(F.col("above").isNull()).select(*out) for rows in (done, closed)]
    every = inner[0].unionAll(inner[1]).unionAll(below(done)).unionAll(below(closed))
    return every.select(*out[:-1], F.lower(F.hex("ends")).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(documents(spark, sf_dir, "conversations")))
