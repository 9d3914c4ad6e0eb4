"""Hashed text features for the trained models, and bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.blocks import SPACE, U, buffers, mix, words
from corpusloom.llm.runtime import cut, small_side, whole_number

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; an absent id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def sample(rows: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` rows of each label, those with the smallest hashes of id and text.

    Labels are counted first; only rows below a hash that twice ``most`` rows of their label
    (and 40 more) fall under are moved to be ranked, whatever the label's size.
    """
    counts = cut(rows.groupBy(label).agg(F.count(F.lit(1)).alias("_all")))
    share = (F.lit(2.0 * most + 40) / F.col("_all")) * F.lit(2.0**64) - F.lit(2.0**63)
    near = rows.withColumn("_hash", F.xxhash64("doc_id", "text")).join(small_side(counts), label).where(F.col("_hash").cast("double") <= share)
    order = Window.partitionBy(label).orderBy("_hash", "doc_id", "text")
    return near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n", "_hash", "_all")


def texts_of(docs: DataFrame, *others: str) -> DataFrame:
    return docs.select(whole_number("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *others)


def byte_grams(data: np.ndarray, offsets: np.ndarray, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams (A-Z lower-cased, blanks as one kind): buckets, and the row of each."""
    folded = LOWER[data].astype(np.uint64)
    folded[SPACE[data]] = U(0x20)
    n = len(data)
    out, owners = [], []
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for order in orders:
        if n < order:
            continue
        value = np.full(n - order + 1, order, dtype=np.uint64)
        for k in range(order):
            value = value * U(257) + folded[k : n - order + 1 + k]
        value *= U(0x9E3779B97F4A7C15)
        inside = owner[: n - order + 1] == owner[order - 1 :]
        out.append((value[inside] >> U(64 - bits)).astype(np.int64))
        owners.append(owner[: n - order + 1][inside])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owners)


def gram_matrix(data: np.ndarray, offsets: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """One row of square-rooted gram frequencies for each text, of length 1."""
    n = len(offsets) - 1
    bucket, owner = byte_grams(data, offsets, orders, bits)
    counts = np.bincount(owner * (1 << bits) + bucket, minlength=n << bits).reshape(n, 1 << bits).astype(np.float32)
    np.sqrt(counts, out=counts)
    return counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)


#: Names of the numbers that ``structure`` gives for each text.
STRUCTURE = (
    "log_chars", "upper", "digit", "symbol", "comma_stop", "bar", "bang", "other", "space", "words", "word_length",
    "distinct_words", "line_length", "short_words", "top_word", "marked_words",
)


def structure(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares that describe the shape of each text, and its word hashes with their offsets."""
    hashes, rows = words(data, offsets)
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    kinds = np.zeros((9, 256), dtype=np.int64)
    kinds[0, 0x41:0x5B] = 1
    kinds[1, 0x30:0x3A] = 1
    for k, characters in ((2, b"#$%&*^~@<>{}[]\\/_=+"), (3, b".,;:"), (4, b"|"), (5, b"!?")):
        kinds[k, list(characters)] = 1
    kinds[6, 0x80:] = 1
    kinds[7, SPACE] = 1
    kinds[8, 0x0A] = 1
    share = []
    for kind in kinds:
        total = np.concatenate([[0], np.cumsum(kind[data])])
        share.append((total[offsets[1:]] - total[offsets[:-1]]) / size)
    count = np.maximum(np.diff(rows), 1).astype(np.float64)
    distinct, top = np.ones(len(count)), np.ones(len(count))
    for i in range(len(count)):
        own = hashes[rows[i] : rows[i + 1]]
        if len(own):
            own = np.sort(own)
            change = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
            distinct[i], top[i] = (len(change) - 1) / len(own), np.diff(change).max() / len(own)
    lines = share[8] * size + 1
    table = np.stack(
        [
            np.log1p(size) / 12, share[0], share[1], share[2] * 4, share[3] * 4, share[4] * 4, share[5] * 4, share[6], share[7],
            np.log1p(count) / 10, np.minimum(size / count, 40) / 40, distinct, np.log1p(size / lines) / 8,
            np.minimum(count / lines, 64) / 64, top, np.minimum(share[2] * size / count, 4) / 4,
        ],
        axis=1,
    )
    return table, hashes, rows


def column(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return buffers(pa.array(texts, pa.string()))


__all__ = ["byte_grams", "column", "gram_matrix", "mix", "remainder", "sample", "structure", "texts_of"]
