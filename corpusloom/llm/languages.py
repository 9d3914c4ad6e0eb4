"""Operator 8, language ID by error-correcting output codes.

Each language has a codeword of bits. For each bit a linear classifier on hashed byte
n-grams predicts it with a margin; the losses of the margins against each codeword, weighted
by how well the bit's classifier does on the training sample, choose the nearest codeword.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.blocks import buffers, slices
from corpusloom.llm.linear_features import column, gram_matrix, remainder, sample, texts_of
from corpusloom.llm.runtime import documents, tidy, unpacked, whole_row

ORDERS = (1, 2, 3)
BITS = 12
#: Most training documents of a language.
SAMPLE = 300
#: Windows of a training document that are examples besides the whole: their sizes in code points.
WINDOWS = (40, 160, 640)
#: A text whose two nearest codewords differ by less is ambiguous.
AMBIGUOUS = 0.05
NONE = "und"


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # bits x features
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit's loss


def codewords(count: int, seed: int = 11) -> np.ndarray:
    """A code for ``count`` classes: all distinct two-way splits for few, else random ones far apart."""
    if count <= 5:
        splits = [(1, *x) for x in itertools.product((1, -1), repeat=count - 1)][1:]
        return np.array(splits, dtype=np.int8).T.reshape(count, -1)
    draw, width = np.random.default_rng(seed), max(15, int(np.ceil(10 * np.log2(count))))
    best, apart = None, -1
    for _ in range(200):
        code = draw.choice(np.array([-1, 1], dtype=np.int8), (count, width))
        code[:, 0] = np.where(np.abs(code.sum(axis=0)[0]) == count, -code[:, 0], code[:, 0])
        near = min(int((code[i] != code[:i]).sum(axis=1).min()) for i in range(1, count))
        if near > apart:
            best, apart = code, near
    return best


def fit(texts: list[str], labels: list[str], epochs: int = 60) -> Model | None:
    """Logistic classifiers for all bits at once, by full-batch gradients with momentum on balanced examples."""
    languages = sorted(set(labels))
    if not languages:
        return None
    examples, classes = [], []
    draw = np.random.default_rng(5)
    for text, label in zip(texts, labels):
        parts = [text]
        for width in WINDOWS:
            if len(text) > width:
                at = int(draw.integers(0, len(text) - width))
                parts.append(text[at : at + width])
        examples += parts
        classes += [languages.index(label)] * len(parts)
    if len(languages) == 1:
        return Model(languages, np.ones((1, 0)), np.zeros((0, 1 << BITS), np.float32), np.zeros(0), np.zeros(0))
    code = codewords(len(languages)).astype(np.float32)
    x = np.concatenate([gram_matrix(*column(examples[i : i + 256]), ORDERS, BITS) for i in range(0, len(examples), 256)])
    y = np.array(classes)
    target = code[y]
    balance = (len(y) / (len(languages) * np.bincount(y, minlength=len(languages))))[y][:, None].astype(np.float32)
    weights, bias = np.zeros((code.shape[1], x.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    speed, speed_bias = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(epochs):
        margin = target * (x @ weights.T + bias)
        pull = balance * target / (1 + np.exp(np.clip(margin, -30, 30))) / len(y)
        speed = 0.9 * speed + 40 * (pull.T @ x - 1e-6 * weights)
        speed_bias = 0.9 * speed_bias + 4 * pull.sum(axis=0)
        weights, bias = weights + speed, bias + speed_bias
    right = (balance * (target * (x @ weights.T + bias) > 0)).mean(axis=0)
    trust = np.maximum(np.log(np.clip(right, 0.5, 0.9999) / (1 - np.clip(right, 0.5, 0.9999))), 1e-3)
    return Model(languages, code, weights.astype(np.float32), bias.astype(np.float32), (trust / trust.sum()).astype(np.float32))


def decode(model: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword of each row by weighted logistic loss, its probability, and the gap to the second."""
    n = len(x)
    if len(model.languages) == 1:
        return np.zeros(n, np.int64), np.ones(n), np.ones(n)
    margin = x @ model.weights.T + model.bias
    loss = np.logaddexp(0, -margin[:, None, :] * model.code[None, :, :]) @ model.trust
    order = np.sort(loss, axis=1)
    scale = np.exp(-(loss - order[:, :1]) * model.code.shape[1])
    return loss.argmin(axis=1), 1 / scale.sum(axis=1), order[:, 1] - order[:, 0]


def train(docs: DataFrame, most: int = SAMPLE) -> Model | None:
    """The model of ``docs``' own languages: at most ``most`` documents of each, crc32 modulo 3 not 1."""
    rows = texts_of(docs, F.col("lang").alias("lang")).where("lang is not null and text <> ''")
    rows = rows.where(remainder(F.col("doc_id"), 3) != 1)
    found = sample(rows, "lang", most).select("text", "lang").collect()  # bounded: ``most`` for each language
    found.sort()
    return fit([x["text"] for x in found], [x["lang"] for x in found])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row of ``docs`` (doc_id, text).

    ``und`` with score 0 if text is null, has no letter, or nothing was learned. Repeated
    rows and rows without doc_id (not held out) each get a row; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            letters = np.array(batch.column("letters").to_pylist(), dtype=bool)
            for first, last in slices(offsets, 1 << 19):
                for begin in range(first, last, 128):
                    end = min(begin + 128, last)
                    x = gram_matrix(data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin], ORDERS, BITS)
                    best, score, gap = decode(model, x)
                    known = letters[begin:end]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": batch.column("doc_id").slice(begin, end - begin),
                            "held_out": batch.column("held_out").slice(begin, end - begin),
                            "lang_pred": pa.array([model.languages[b] if k else NONE for b, k in zip(best, known)], pa.string()),
                            "score": pa.array(np.where(known, score, 0.0).astype(np.float64)),
                            "ambiguous": pa.array(known & (gap < AMBIGUOUS)),
                        }
                    )

    rows = texts_of(docs).withColumns({"held_out": remainder(F.col("doc_id"), 3) == 1, "letters": F.col("text").rlike(r"\p{L}")})
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    return rows.mapInArrow(tidy(run), "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language can't be told: no letter in the text, or ambiguous.

    Each row goes or stays by its own text, also where a doc_id is absent or repeats; null, empty and
    blank texts go. Where nothing was learned, no row stays; an empty table gives an empty result.
    Other columns are kept under any names.
    """
    model = train(docs)
    if model is None:
        return docs.where(F.lit(False))
    text = F.coalesce("text", F.lit(""))
    wide = docs.select(whole_row(docs).alias("row"), text.alias("_text"), text.rlike(r"\p{L}").alias("_letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("_text"))
            stays = np.array(batch.column("_letters").to_pylist(), dtype=bool)
            for first, last in slices(offsets, 1 << 19):
                for begin in range(first, last, 128):
                    end = min(begin + 128, last)
                    x = gram_matrix(data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin], ORDERS, BITS)
                    stays[begin:end] &= decode(model, x)[2] >= AMBIGUOUS
            yield batch.select(["row"]).filter(pa.array(stays))

    return unpacked(wide.mapInArrow(tidy(run), wide.select("row").schema), docs.columns)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``identify`` for all documents by the model of their own ``train``."""
    docs = documents(spark, sf_dir)
    return identify(docs, train(docs))
