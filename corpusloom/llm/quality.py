"""Operator 3, quality classifier: a factorisation machine.

Its inputs are hashed words, statistics of the text's structure and its length as metadata.
The pairwise terms have rank RANK and are summed in linear time: half the difference of
the squared sum and the sum of squares of each factor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.blocks import U, buffers, slices
from corpusloom.llm.linear_features import STRUCTURE, column, remainder, sample, structure, texts_of
from corpusloom.llm.runtime import documents, tidy, whole_number

BITS = 14
RANK = 4
CUTS = 8
#: Most training documents of a label.
SAMPLE = 1000
LIMIT = 0.3
FIRST_WORD = len(STRUCTURE) * CUTS


@dataclass
class Machine:
    cuts: np.ndarray  # structure x (CUTS - 1) inner quantiles
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # features x RANK


def features(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse inputs: index, value and row of each entry; structure numbers fall between their cuts."""
    table, hashes, rows = structure(data, offsets)
    n = len(table)
    index, value, owner = [], [], []
    for k in range(table.shape[1]):
        index.append(k * CUTS + np.searchsorted(cuts[k], table[:, k]))
        value.append(np.full(n, 1 / np.sqrt(table.shape[1])))
        owner.append(np.arange(n))
    lengths = np.diff(rows)
    if len(hashes):
        bucket = (hashes >> U(64 - BITS)).astype(np.int64)
        key = np.repeat(np.arange(n), lengths) * (1 << BITS) + bucket
        key, often = np.unique(key, return_counts=True)
        row = key >> BITS
        weight = np.log1p(often)
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=n))
        index.append(FIRST_WORD + (key & ((1 << BITS) - 1)))
        value.append(weight / norm[row])
        owner.append(row)
    return np.concatenate(index), np.concatenate(value), np.concatenate(owner)


def raw(machine: Machine, index: np.ndarray, value: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The machine's output for each row, and the factor sums that its gradient needs."""
    linear = np.bincount(owner, machine.linear[index] * value, minlength=n)
    out = machine.bias + linear
    sums = np.empty((n, machine.factors.shape[1]))
    for f in range(machine.factors.shape[1]):
        part = machine.factors[index, f] * value
        sums[:, f] = np.bincount(owner, part, minlength=n)
        out = out + 0.5 * (sums[:, f] ** 2 - np.bincount(owner, part * part, minlength=n))
    return out, sums


def fit(texts: list[str], labels: list[int], prior: float, epochs: int = 20, seed: int = 3) -> Machine | None:
    """Adagrad on the logistic loss in small batches; examples are weighted so that label 1 has share ``prior``."""
    if not texts:
        return None
    y = np.array(labels, dtype=np.float64)
    draw = np.random.default_rng(seed)
    tables = [structure(*column(texts[i : i + 256]))[0] for i in range(0, len(texts), 256)]
    cuts = np.quantile(np.concatenate(tables), np.arange(1, CUTS) / CUTS, axis=0).T
    size = FIRST_WORD + (1 << BITS)
    machine = Machine(cuts, float(np.log(prior / (1 - prior))), np.zeros(size), draw.normal(0, 0.02, (size, RANK)))
    ones = max(y.mean(), 1e-9)
    weight = np.where(y == 1, prior / ones, (1 - prior) / max(1 - ones, 1e-9))
    seen, seen_linear, seen_factors = 1e-3, np.full(size, 1e-3), np.full((size, RANK), 1e-2)
    order, batches = draw.permutation(len(texts)), []
    for i in range(0, len(texts), 64):
        pick = order[i : i + 64]
        batches.append((pick, *features(*column([texts[j] for j in pick]), cuts)))
    for _ in range(epochs):
        for k in draw.permutation(len(batches)):
            pick, index, value, owner = batches[k]
            out, sums = raw(machine, index, value, owner, len(pick))
            pull = weight[pick] * (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[pick]) / len(pick)
            g = np.bincount(index, pull[owner] * value, minlength=size) + 1e-5 * machine.linear
            seen_linear += g * g
            machine.linear -= 0.3 * g / np.sqrt(seen_linear)
            for f in range(RANK):
                own = machine.factors[:, f]
                g = np.bincount(index, pull[owner] * value * (sums[owner, f] - own[index] * value), minlength=size) + 1e-5 * own
                seen_factors[:, f] += g * g
                machine.factors[:, f] = own - 0.05 * g / np.sqrt(seen_factors[:, f])
            seen += pull.sum() ** 2
            machine.bias -= 0.05 * pull.sum() / np.sqrt(seen)
    return machine


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Machine | None:
    """A machine from at most ``most`` documents of each label whose crc32 modulo 5 isn't 0.

    The sample is balanced as far as the labels go; weights restore the labels' own shares.
    """
    marks = labels.select(whole_number("doc_id").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marks = marks.where(remainder(F.col("doc_id"), 5) != 0)
    shares = {x["quality"]: x["count"] for x in marks.groupBy("quality").count().collect()}
    if not shares:
        return None
    picked = sample(marks.withColumn("text", F.lit("")), "quality", most).drop("text")
    found = sample(texts_of(docs).join(F.broadcast(picked), "doc_id"), "quality", most)  # picked: at most 2 x ``most`` ids
    rows = sorted(found.select("doc_id", "text", "quality").collect())  # bounded alike
    prior = min(max(shares.get(1, 0) / sum(shares.values()), 0.01), 0.99)
    return fit([x["text"] for x in rows], [x["quality"] for x in rows], prior)


def quality(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    Null counts as empty and is scored like any text. Without a single label every score is
    0.5. Repeated rows each get a row; rows without doc_id aren't held out, as crc32 of
    nothing is taken as 1; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for first, last in slices(offsets):
                part = features(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], machine.cuts)
                out, _ = raw(machine, *part, last - first)
                score = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(first, last - first),
                        "held_out": batch.column("held_out").slice(first, last - first),
                        "score": pa.array(score, pa.float64()),
                        "predicted": pa.array(score >= LIMIT).cast(pa.int32()),
                    }
                )

    rows = texts_of(docs).withColumn("held_out", F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 5) == 0))
    if machine is None:
        return rows.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    return rows.mapInArrow(tidy(run), "doc_id bigint, held_out boolean, score double, predicted int")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``quality`` of all documents by the machine that ``train`` makes of them and their labels."""
    docs = documents(spark, sf_dir)
    return quality(docs, train(docs, documents(spark, sf_dir, "labels")))
