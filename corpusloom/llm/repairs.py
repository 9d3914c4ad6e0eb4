"""Operator 13, repair of damaged conversations by signature deduplication.

Of a conversation only the sequence of its rows' roles and faults decides which edits are
cheapest. That sequence is a compact string, one character a row: the signature. Conversations
of one shape share it, so each distinct signature is solved once, by a memoised recursion over
its halves: a stretch of a signature is a matrix of cheapest costs from state to state of the
automaton of legal roles, and the matrix of a stretch is the (min, +) product of its halves'.
Going down the same halves with the costs of what follows gives the states between them, and
so the edits. The audits are joined back and replayed on the rows.

Rows travel twice: without their texts to spell the signatures, with them to be replayed. Both
times a conversation's rows come one after another, so that it may be of any length; a
character a row of it is held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.prefix_trie import crc
from corpusloom.llm.runtime import documents, parts, stored, tidy, whole_number

# The damage by crc32(conv_id:turn) % 20, the costs, and the blanks.
DAMAGES = 20
DROP, EMPTY, UNPOINT, REPEAT, RELABEL = range(5)
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
#: States of the automaton of ``(s?(ua)+)?``: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
REACHED = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {"u": "user", "a": "assistant"}
NEVER = 1 << 60
#: Characters of a signature: a row's role initial (o: any other), upper case if truncated; x must go.
MUST_GO = "x"
#: Bytes of signatures and audits that are broadcast, and copies of them otherwise.
BROADCAST_BYTES, SALTS = 1 << 22, 8

Matrix = tuple[tuple[int, ...], ...]


def inserted(state: int, n: int) -> int:
    """The state after ``n`` inserted turns."""
    for _ in range(n):
        state = REACHED[NEXT[state]]
    return state


def kept(state: int, role: str) -> int | None:
    """The state after a row keeps its role, if it may."""
    if role == "s":
        return SYSTEM if state == START else None
    return REACHED[role] if role == NEXT[state] else None


def edits(state: int, symbol: str) -> list[tuple[str, int, int]]:
    """What can be done with a row in a state, least initial first: initial, cost, next state."""
    out = [("D", DELETE, state)]
    if symbol != MUST_GO:
        fault = TRUNCATED if symbol.isupper() else 0
        if (to := kept(state, symbol.lower())) is not None:
            out.append(("K", fault, to))
        out.append(("R", REROLE + fault, REACHED[NEXT[state]]))
    return out


@lru_cache(maxsize=1 << 16)
def costs(stretch: str) -> Matrix:
    """The least costs from each state to each other over a stretch of a signature, insertions before its rows included."""
    if len(stretch) == 1:
        table = [[NEVER] * 4 for _ in STATES]
        for a in STATES:
            for n in range(3):  # a third insertion would lead to a state that one has led to
                for _, cost, to in edits(inserted(a, n), stretch):
                    table[a][to] = min(table[a][to], n * INSERT + cost)
        return tuple(map(tuple, table))
    half = len(stretch) // 2
    left, right = costs(stretch[:half]), costs(stretch[half:])
    return tuple(tuple(min(left[a][m] + right[m][b] for m in STATES) for b in STATES) for a in STATES)


def ending() -> tuple[int, ...]:
    """Costs after the last row: turns inserted until the sequence is legal."""
    return tuple(next(n * INSERT for n in range(3) if inserted(s, n) in (START, ASSISTANT)) for s in STATES)


def before(stretch: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a stretch, from those after it."""
    table = costs(stretch)
    return tuple(min(table[a][b] + after[b] for b in STATES) for a in STATES)


def walk(stretch: str, state: int, after: tuple[int, ...], out: list[str]) -> int:
    """Append the edits of a stretch, the ASCII-least of the cheapest, and return the state behind it."""
    if len(stretch) > 1:
        half = len(stretch) // 2
        state = walk(stretch[:half], state, before(stretch[half:], after), out)
        return walk(stretch[half:], state, after, out)
    left = before(stretch, after)[state]
    while True:  # from each state every initial leads to one state, so the least initial that keeps the cost is right
        ways = edits(state, stretch)
        ways.insert(1, ("I", INSERT, REACHED[NEXT[state]]))
        for initial, cost, to in ways:
            if cost + (before(stretch, after)[to] if initial == "I" else after[to]) == left:
                out.append(initial)
                state, left = to, left - cost
                break
        if out[-1] != "I":
            return state


def solve(signature: str) -> tuple[int, str]:
    """Least cost and audit of a signature."""
    after, out, state = ending(), [], START
    total = before(signature, after)[START] if signature else after[START]
    if signature:
        state = walk(signature, START, after, out)
    return total, "".join(out) + "I" * (after[state] // INSERT)


def damaged(turns: DataFrame) -> DataFrame:
    """The rows of ``turns`` (conv_id, turn, role, text) after damage: conv_id, turn, role, text, copy, gone.

    ``copy`` is 1 for a repetition; rows that are dropped stay as ``gone``, so that their
    conversation is known. Nulls count as one space, in the number that decides about the
    damage too; null conv_id is a conversation of its own.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(x).cast("string"), space) for x in ("conv_id", "turn")))
    given = turns.select(whole_number("conv_id").alias("conv_id"), whole_number("turn").alias("turn"), *(F.coalesce(x, space).alias(x) for x in ("role", "text"))).withColumn("_hit", crc(key) % DAMAGES)
    hit = F.col("_hit")
    text = F.when(hit == EMPTY, "").when(hit == UNPOINT, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = given.select("conv_id", "turn", F.when(hit == RELABEL, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (hit == DROP).alias("gone"), F.when(hit == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", "gone", F.explode("copies").alias("copy"))


def order() -> list[Column]:
    """The order of a conversation's rows: turn, null first; ties by role and the text's digest, repetitions adjacent."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("copy")]


def spelled(rows: DataFrame) -> DataFrame:
    """The damaged rows without texts, in order within their conversation: conv_id, turn, role, blank, truncated, first."""
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    narrow = rows.select("conv_id", "turn", "role", "copy", "gone", F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("digest"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))
    seen = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("gone"), *order())
    return narrow.repartition(parts(rows.sparkSession), "conv_id").withColumn("first", F.row_number().over(seen) == 1).sortWithinPartitions("conv_id", *order())


def _streams(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Each conversation's rows, as they come; what isn't read of one is passed over."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(x).to_pylist() for x in ("conv_id", *columns)))

    source = rows()
    at = next(source, None)

    def own(conv_id: int | None) -> Iterator[tuple]:
        nonlocal at
        while at is not None and at[0] == conv_id:
            now, at = at, next(source, None)
            yield now[1:]

    while at is not None:
        conv_id = at[0]
        group = own(conv_id)
        yield conv_id, group
        for _ in group:
            pass


def symbol(role: str, must_go: bool, truncated: bool) -> str:
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return MUST_GO if must_go else initial.upper() if truncated else initial


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("signature", pa.string()), *((x, pa.int64()) for x in ("gaps", "blank", "duplicate", "truncated", "illegal"))])
    out: list[tuple] = []
    held = 0
    for conv_id, rows in _streams(batches, ("turn", "role", "gone", "blank", "truncated", "first")):
        signature: list[str] = []
        counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        least = most = before = None
        distinct = 0
        for turn, role, gone, blank, truncated, first in rows:
            if gone:
                continue
            if turn is not None and turn != most:
                least, most, distinct = turn if least is None else least, turn, distinct + 1
            fault = "blank" if blank else "duplicate" if not first else "truncated" if truncated else None
            if fault:
                counts[fault] += 1
            counts["illegal"] += before is not None and before + role[:1] not in ("su", "ua", "au")
            before = role[:1]
            signature.append(symbol(role, fault in ("blank", "duplicate"), fault == "truncated"))
        out.append((conv_id, "".join(signature), 0 if least is None else most - least + 1 - distinct, *counts.values()))
        held += len(signature) + 64
        if held > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = [solve(x) for x in batch.column("signature").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("signature"), pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.string())], ["signature", "cost", "audit"])


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, signature, gaps, blank, duplicate, truncated, illegal of each conversation of ``damaged`` rows."""
    return spelled(rows).mapInArrow(tidy(_spell), "conv_id bigint, signature string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint")


def audited(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, signature and more, materialised) with cost and audit; every distinct signature is solved once."""
    distinct = conversations.select("signature").distinct().repartition(parts(conversations.sparkSession), "signature")
    solved = stored(distinct.mapInArrow(tidy(_solved), "signature string, cost bigint, audit string"), "audits")
    size = solved.agg(F.sum(F.length("signature") + F.length("audit") + 32)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return conversations.join(F.broadcast(solved), "signature")
    salted = solved.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # a third of all may share a signature
    return conversations.withColumn("_salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int")).join(salted, ["signature", "_salt"]).drop("_salt")


def replayed(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) sequence of rows under an audit."""
    state = START
    for initial in audit:
        if initial == "I":
            yield ROLES[NEXT[state]], ""
            state = REACHED[NEXT[state]]
            continue
        role, text = next(rows)
        if initial == "K":
            yield role, text
            state = REACHED[role[:1]]
        elif initial == "R":
            yield ROLES[NEXT[state]], text
            state = REACHED[NEXT[state]]


def _replay(sink: Callable[[int | None, str, Iterator[tuple[str, str]]], Iterator[tuple]], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For streams that hold a conversation's audit before its rows: ``sink`` of conv_id, audit and repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0
        for conv_id, rows in _streams(batches, ("audit", "role", "text")):
            audit = next(rows)[0]
            for row in sink(conv_id, audit, replayed(audit, ((role, text) for _, role, text in rows))):
                out.append(row)
                held += 64 + sum(len(x) for x in row if isinstance(x, str))
                if held > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return tidy(run)


def with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit, and then its ``damaged`` rows in order, in one partition."""
    text = rows.where(~F.col("gone")).select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("digest"), "copy", "text", F.lit(None).cast("string").alias("audit"))
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.unhex(F.lit("")).alias("digest"), F.lit(0).alias("copy"), F.lit("").alias("text"), "audit")
    both = heads.unionAll(text).repartition(parts(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "kind", *order())
    return both.select("conv_id", "audit", "role", "text")


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired conversations of ``turns`` (conv_id, turn, role, text), not damaged first: conv_id, turn (from 0), role, text.

    Blank rows and repeated ones (equal role and text) go; ties, nulls and order are those of
    ``order`` and ``damaged``. A conversation of which nothing is left gives no row.
    """
    space = F.lit(" ")
    rows = turns.select(whole_number("conv_id").alias("conv_id"), whole_number("turn").alias("turn"), *(F.coalesce(x, space).alias(x) for x in ("role", "text")), F.lit(False).alias("gone"), F.lit(0).alias("copy"))
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def every(conv_id, audit, found):
        return ((conv_id, k, *x) for k, x in enumerate(found))

    audits = audited(stored(signatures(rows), "signatures"))
    return with_audits(rows, audits).mapInArrow(_replay(every, schema), "conv_id bigint, turn bigint, role string, text string")


def reports(rows: DataFrame) -> DataFrame:
    """A row for each conversation of ``damaged`` rows: its faults, the cheapest repair and the repaired text's digest.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Roles
    count by their first character; a role without one, or with another than s, u and a, can't
    be kept. Ties and nulls as in ``order`` and ``damaged``; an empty table gives an empty result.
    """
    found = stored(audited(stored(signatures(rows), "signatures")).drop("signature"), "reports")
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def digest(conv_id, audit, lines):
        running = hashlib.sha256()
        for k, (role, text) in enumerate(lines):
            running.update(("\n" * (k > 0) + f"{role}:{text}").encode())
        yield conv_id, running.hexdigest()

    digests = with_audits(rows, found).mapInArrow(_replay(digest, schema), "conv_id bigint, repaired_sha256 string")
    other = digests.withColumnRenamed("conv_id", "_conv")
    return found.join(other, F.col("conv_id").eqNullSafe(F.col("_conv"))).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(damaged(documents(spark, sf_dir, "conversations")))
