"""Operator 10, chat formatting by minimum-cost role repair.

The legal-turn automaton: an optional system turn, then user and assistant in turn, from
user on. Each input turn is emitted under its role, relabelled, or merged into the turn
before; empty turns may be inserted before it. Dynamic programming finds the cheapest way.

A conversation may be of any length. Rows are numbered in the order of conversation and
turn and dealt to blocks of BLOCK rows. A block's part of a conversation acts on the
automaton's states as a matrix of cheapest ways, and matrices multiply by (min, +): one
pass makes the matrices, one walks over each conversation's matrices and fixes the states
between blocks, and one repairs and renders each part between its fixed states.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.runtime import cut, dense_ids, documents, parts, tidy, whole_number

ROLES = ("system", "user", "assistant")
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: State -> roles that may be emitted next.
NEXT = {START: ("system", "user"), AFTER_SYSTEM: ("user",), AFTER_USER: ("assistant",), AFTER_ASSISTANT: ("user",)}
STATE = {"system": AFTER_SYSTEM, "user": AFTER_USER, "assistant": AFTER_ASSISTANT}
ROLE = {v: k for k, v in STATE.items()}
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1, 2, 1, 3
BLOCK = 512

Way = tuple[int, tuple[str, ...], str, str]  # cost, roles of inserted turns, action, role


def relabel(role: str | None, to: str) -> int:
    return 0 if role == to else RELABEL if role in ROLES else RELABEL_UNKNOWN


@lru_cache(maxsize=None)
def ways(role: str | None) -> dict[tuple[int, int], Way]:
    """The cheapest way to take one turn of ``role`` from each state to each other."""
    found: dict[tuple[int, int], Way] = {}
    for start in STATE_ALL:
        reach: list[tuple[int, int, tuple[str, ...]]] = [(0, start, ())]
        for _ in range(2):
            reach += [(c + INSERT, STATE[q], (*ins, q)) for c, s, ins in reach for q in NEXT[s] if len(ins) < 2]
        options: list[tuple[int, Way]] = []
        for cost, s, inserted in sorted(set(reach), key=lambda x: (x[0], x[2])):
            for q in NEXT[s]:
                options.append((STATE[q], (cost + relabel(role, q), inserted, "emit" if role == q else "relabel", q)))
            if s != START and not inserted:
                options.append((s, (cost + MERGE + relabel(role, ROLE[s]), inserted, "merge", ROLE[s])))
        for end, way in options:
            if (start, end) not in found or (way[0], len(way[1])) < (found[start, end][0], len(found[start, end][1])):
                found[start, end] = way
    return found


STATE_ALL = (START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT)


def tie(conv_id, turn, a: int, b: int) -> int:
    """Decides between ways of equal cost by the turn alone, wherever blocks begin."""
    return int.from_bytes(hashlib.blake2b(f"{conv_id}/{turn}/{a}/{b}".encode(), digest_size=4).digest())


def walk(rows: list[tuple], start: dict[int, tuple]) -> list[dict[int, tuple]]:
    """Forward costs: before the first and after each row, state -> (cost, tie, turns made, state before)."""
    table = [start]
    for conv_id, turn, role in rows:
        now: dict[int, tuple] = {}
        for (a, b), (cost, inserted, action, _) in ways(role).items():
            if a in table[-1]:
                old = table[-1][a]
                new = (old[0] + cost, old[1] + tie(conv_id, turn, a, b), old[2] + len(inserted) + (action != "merge"), a)
                if b not in now or new < now[b]:
                    now[b] = new
        table.append(now)
    return table


def path(rows: list[tuple], start: int, end: int) -> list[Way]:
    """The cheapest way of each row between two states."""
    table = walk(rows, {start: (0, 0, 0, start)})
    out, state = [], end
    for k in range(len(rows), 0, -1):
        before = table[k][state][3]
        out.append(ways(rows[k - 1][2])[before, state])
        state = before
    return out[::-1]


def repair(roles: list[str | None]) -> tuple[int, list[Way]]:
    """Cost and ways of a whole short conversation."""
    rows = [("", k, role) for k, role in enumerate(roles)]
    table = walk(rows, {START: (0, 0, 0, START)})
    end = min(table[-1], key=lambda s: table[-1][s][:2])
    return table[-1][end][0], path(rows, START, end)


def opening(role: str, first: bool) -> str:
    return ("" if first else "<|end|>\n") + f"<|{role}|>\n"


def _streams(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows with equal keys, in the order in which they come."""
    at, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != at:
                if rows:
                    yield at, rows
                at, rows = key, []
            rows.append(row)
    if rows:
        yield at, rows


def formatted(turns: DataFrame) -> DataFrame:
    """The rendered, repaired conversations of ``turns`` (conv_id, turn, role, text), piece by piece.

    A piece is an input turn, or an inserted empty one. Returned: conv_id, turn (null if
    inserted), out_turn (from 0) and part (the pieces of a merged turn share out_turn),
    role, action (emit, relabel, merge, insert), rendered; part is -1 for a turn's first piece
    and grows with the later ones. The pieces' texts in the order
    of out_turn and part are the conversation: turns open with <|role|> and close with
    <|end|>, merged texts are joined by a line feed.

    Order: turn, null last, then role and text; repeated rows are turns of their own. Role
    is compared without blanks and case; null and unknown roles cost less to relabel. Null
    text counts as empty. Null conv_id is one conversation. An empty table gives an empty
    result; other columns are ignored.
    """
    spark = turns.sparkSession
    n = parts(spark)
    known = F.lower(F.trim("role"))
    base = turns.select(
        whole_number("conv_id").alias("conv_id"), whole_number("turn").alias("turn"), F.when(known.isin(*ROLES), known).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    base = base.withColumn("_row", F.monotonically_increasing_id())  # splits the range of many equal rows
    order = (F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"), F.col("_row"))
    rows = cut(dense_ids(cut(base), *order, name="place").drop("_row").withColumn("block", F.floor(F.col("place") / BLOCK)))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block, conv_id), own in _streams(batches, ("block", "conv_id")):
            items = [(x["conv_id"], x["turn"], x["role"]) for x in own]
            cells = []
            for a in STATE_ALL:
                for b, (cost, ties, made, _) in walk(items, {a: (0, 0, 0, a)})[-1].items():
                    cells.append({"a": a, "b": b, "cost": cost, "tie": ties, "made": made})
            yield pa.RecordBatch.from_pylist([{"conv_id": conv_id, "block": block, "cells": cells}], schema=matrix)

    cell = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("tie", pa.int64()), ("made", pa.int64())])
    matrix = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("cells", pa.list_(cell))])
    dealt = rows.select("block", "conv_id", "turn", "role", "place").repartition(n, "block").sortWithinPartitions("block", "place")
    steps = dealt.mapInArrow(tidy(matrices), "conv_id bigint, block bigint, cells array<struct<a:int,b:int,cost:bigint,tie:bigint,made:bigint>>")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for _, own in _streams(batches, ("conv_id",)):
            table = [{START: (0, 0, 0, START)}]
            for x in own:
                now: dict[int, tuple] = {}
                for c in x["cells"]:
                    if c["a"] in table[-1]:
                        old = table[-1][c["a"]]
                        new = (old[0] + c["cost"], old[1] + c["tie"], old[2] + c["made"], c["a"])
                        if c["b"] not in now or new < now[c["b"]]:
                            now[c["b"]] = new
                table.append(now)
            state = min(table[-1], key=lambda s: table[-1][s][:2])
            for k in range(len(own), 0, -1):
                before = table[k][state][3]
                out.append({"conv_id": own[k - 1]["conv_id"], "block": own[k - 1]["block"], "enter": before, "leave": state, "made": table[k - 1][before][2], "ends": k == len(own)})
                state = before
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=fixed)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=fixed)

    fixed = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32()), ("made", pa.int64()), ("ends", pa.bool_())])
    states = steps.repartition(n, "conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(tidy(chain), "conv_id bigint, block bigint, enter int, leave int, made bigint, ends boolean")
    states = cut(states.withColumnRenamed("conv_id", "_conv").withColumnRenamed("block", "_block"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, conv_id), own in _streams(batches, ("block", "conv_id")):
            items = [(x["conv_id"], x["turn"], x["role"]) for x in own]
            made, out = own[0]["made"], []
            for x, (_, inserted, action, role) in zip(own, path(items, own[0]["enter"], own[0]["leave"])):
                for q in inserted:
                    out.append((conv_id, None, made, -1, q, "insert", opening(q, made == 0)))
                    made += 1
                if action == "merge":
                    out.append((conv_id, x["turn"], made - 1, x["place"], role, action, "\n" + x["text"]))
                else:
                    out.append((conv_id, x["turn"], made, -1, role, action, opening(role, made == 0) + x["text"]))
                    made += 1
            if own[0]["ends"]:
                out[-1] = (*out[-1][:6], out[-1][6] + "<|end|>\n")
            columns = list(zip(*out))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "turn", "out_turn", "part", "role", "action", "rendered"])

    wide = rows.join(states, rows["conv_id"].eqNullSafe(states["_conv"]) & (rows["block"] == states["_block"])).drop("_conv", "_block")
    wide = wide.repartition(n, "block").sortWithinPartitions("block", "place")
    return wide.mapInArrow(tidy(render), "conv_id bigint, turn bigint, out_turn bigint, part bigint, role string, action string, rendered string")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces with their rendered texts' code points and SHA-256."""
    done = formatted(documents(spark, sf_dir, "conversations"))
    return done.select(
        "conv_id", "turn", "out_turn", "part", "role", "action",
        F.length("rendered").cast("bigint").alias("n_chars"), F.sha2("rendered", 256).alias("rendered_sha256"), "rendered",
    )
