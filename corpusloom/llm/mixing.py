"""Operator 7, mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the expected number of copies of each of its
documents. Its whole part is taken at once; the fractions are rounded in pairs: a random
transfer between two documents, which keeps both expectations and the pair's words, makes
one fraction 0 or 1. Each bucket of documents leaves at most one fraction for each source;
a reduction tree pairs these leftovers level by level until one is left, rounded by itself.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.runtime import cut, dense_ids, documents, parts, tidy, unpacked, whole_number, whole_row

MOST = 3
FAN = 16
BUCKET_ROWS = 2000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text) -> F.Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target for every source of ``sizes`` (source, size).

    Sources in the order of code points, null last, weigh 1, 2, 3, 1, ... The level that
    all weights share rises as sources stop at MOST times their size, until none is above.
    """
    table = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    ranked = dense_ids(table, F.col("source").isNull(), F.col("source"), name="_place")
    ranked = cut(ranked.select("source", "source_size", (F.col("_place") % 3 + 1).cast("double").alias("weight")))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * level > MOST * F.col("source_size")
        state = ranked.agg(
            F.coalesce(F.sum(F.when(over, MOST * F.col("source_size"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)), F.count_if(over)
        ).first()
        if state[2] == capped or not state[1]:
            break
        capped, level = state[2], (total - state[0]) / state[1]
    target = F.least(F.col("weight") * level, MOST * F.col("source_size").cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def draws(*name) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(repr(name).encode(), digest_size=8).digest()))


def pivot(p: float, v: float, q: float, w: float, draw: float) -> tuple[float, float]:
    """One random transfer between fractions ``p`` and ``q`` of documents of ``v`` and ``w`` words."""
    gain = min((1 - p) * v, q * w)  # words from the second to the first
    loss = min(p * v, (1 - q) * w)
    if draw * (gain + loss) < loss:
        return (1.0 if gain == (1 - p) * v else p + gain / v), (0.0 if gain == q * w else q - gain / w)
    return (0.0 if loss == p * v else p - loss / v), (1.0 if loss == (1 - q) * w else q + loss / w)


def rounded(rows: list[tuple], name: tuple) -> list[tuple]:
    """(key, words, fraction) rounded in pairs; at most one fraction stays between 0 and 1."""
    draw, out, held = draws(*name), [], None
    for key, words, p in rows:
        if held is None:
            held = (key, words, p)
        else:
            a, b = pivot(held[2], held[1], p, words, float(draw.random()))
            first, second = (held[0], held[1], a), (key, words, b)
            open_first, open_second = 0 < a < 1, 0 < b < 1
            if open_first and open_second:  # one was within rounding error of its bound
                b, open_second = float(round(b)), False
                second = (key, words, b)
            out += [x for x, is_open in ((first, open_first), (second, open_second)) if not is_open]
            held = first if open_first else second if open_second else None
    return out + ([held] if held is not None else [])


def reduce_level(table: DataFrame, level: int, last: bool) -> DataFrame:
    """One level of the tree over (group, source, key, words, p): groups of FAN buckets' leftovers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            out: list[tuple] = []
            for group, source, key, words, p in zip(*(batch.column(c).to_pylist() for c in ("group", "source", "key", "words", "p"))):
                if (group, source) != at:
                    out += close(at, rows)
                    at, rows = (group, source), []
                rows.append((key, words, p))
            if out:
                yield record(out)
        if out := close(at, rows):
            yield record(out)

    def close(at: tuple | None, rows: list[tuple]) -> list[tuple]:
        done = rounded(rows, (level, *at)) if rows else []
        if last and done and 0 < done[-1][2] < 1:
            key, words, p = done[-1]
            done[-1] = (key, words, float(draws("last", *at).random() < p))
        return [(*at, *x) for x in done]

    def record(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["group", "source", "key", "words", "p"])

    n = parts(table.sparkSession)
    dealt = table.repartition(n, "group", "source").sortWithinPartitions("group", "source", "key")
    return dealt.mapInArrow(tidy(run), "group bigint, source string, key bigint, words bigint, p double")


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for every row of ``docs`` (doc_id, text, source).

    size counts the words of the text (null: 0). Null is a source of its own; a source
    without words has target 0. A document is taken floor(c) or floor(c) + 1 times, for c
    its source's target over its size, never over MOST times. Draws depend on ids, sizes and
    sources alone, so reruns agree; rows that repeat an id are told apart by size, and equal
    ones are interchangeable. An empty table gives an empty result.
    """
    base = docs.select(whole_number("doc_id").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    base = cut(base)
    rows = base.count()
    buckets = 1 << max(0, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS)))
    # A key for each row that has nothing to do with where it lies: rows in the order of id, source and size.
    named = dense_ids(base, F.col("doc_id"), F.col("source"), F.col("size"), name="key")
    goal = cut(targets(base))
    keyed = cut(named.join(goal, named["source"].eqNullSafe(goal["source"])).select(
        "key", "doc_id", named["source"], "size", "source_size", "target",
        F.least(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0), F.lit(float(MOST))).alias("c"),
    ))
    whole = F.floor("c").cast("bigint")
    part = F.col("c") - whole
    open_rows = keyed.where((F.col("size") > 0) & (part > 0))
    level = open_rows.select(
        F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("group"), "source", "key", F.col("size").alias("words"), part.alias("p")
    )
    depth, closed = 0, None
    while True:
        done = cut(reduce_level(level, depth, buckets == 1))
        now = done.where("p = 0 or p = 1").select("key", "p")
        closed = now if closed is None else closed.union(now)
        if buckets == 1:
            break
        buckets = max(1, -(-buckets // FAN))
        level = done.where("p > 0 and p < 1").select(F.pmod("group", F.lit(buckets)).alias("group"), "source", "key", "words", "p")
        depth += 1
    copies = F.least(whole + F.coalesce("p", F.lit(0.0)).cast("bigint"), F.lit(MOST))
    return keyed.join(closed, "key", "left").select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("bigint").alias("taken"), copies.cast("int").alias("copies"), "source"
    )


def take(docs: DataFrame) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; documents not taken go.

    Rows of one id, source and size share their copies as evenly as may be. Documents without a word
    go; null is a source of its own; rows without doc_id count like others. An empty table gives an
    empty result; all columns are kept under any names.
    """
    def keys(n: F.Column) -> dict[str, F.Column]:
        """The three values without nulls, so that the join and the numbering share one shuffle."""
        return {
            "_id": F.coalesce(whole_number("doc_id"), F.lit(0).cast("bigint")), "_source": F.coalesce(F.col("source").cast("string"), F.lit("")),
            "_given": F.col("doc_id").isNotNull().cast("int") * 2 + F.col("source").isNotNull().cast("int"), "_size": n,
        }

    size = word_count(F.col("text"))
    names = list(keys(size))
    counts = mixed(docs).withColumns(keys(F.col("size"))).groupBy(*names).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    held = docs.select(*(c.alias(n) for n, c in keys(size).items()), F.col("text").alias("_text"), whole_row(docs).alias("row"))
    place = F.row_number().over(Window.partitionBy(*names).orderBy("_text"))
    each = F.floor(F.col("_copies") / F.col("_rows")) + (place <= F.col("_copies") % F.col("_rows")).cast("int")
    numbered = held.join(counts, names).withColumn("_each", each.cast("int")).where("_each > 0")
    return unpacked(numbered.select("row", F.explode(F.array_repeat(F.lit(1), F.col("_each")))), docs.columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mixed`` for all documents."""
    return mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
