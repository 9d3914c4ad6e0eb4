"""Operator 1, document fingerprints: MinHash signatures, bands joined in Spark, Jaccard verified."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import links
from corpusloom.llm.blocks import MinHash, buffers, shingles, slices, words
from corpusloom.llm.runtime import documents, parts, tidy, whole_number

PERMUTATIONS = 128
BANDS = 25  # of five values each: a pair at 0.8 shares no band in 0.005 % of draws


def texts_signatures(texts: list[bytes], hasher: MinHash) -> np.ndarray:
    """The signature of each text."""
    data, offsets = buffers(pa.array(texts, pa.binary()).cast(pa.large_binary()))
    return hasher.signatures(*shingles(*words(data, offsets)))


def written(signature: np.ndarray) -> str:
    """A signature as text: base64 of its little-endian 32-bit values."""
    return base64.b64encode(signature.astype("<u4").tobytes()).decode()


def signature_of(fingerprint: str) -> np.ndarray:
    """The signature that ``written`` made a text of."""
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal values: an estimate of the Jaccard similarity of the shingle sets."""
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first code points of ``following``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def successors(docs: DataFrame) -> DataFrame:
    """Rows dealt so that each task holds a run of descending ids and the row that follows it.

    The cuts are quantiles of the ids and themselves ids. The row of a cut goes to the
    task below and, as a tail, to the task above; the largest id is the tail of the last
    task, since the first document follows the last. Texts move once.
    """
    spark = docs.sparkSession
    n = parts(spark)
    rows = docs.select(whole_number("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / n for k in range(1, n)] or [0.5]
    found = rows.agg(F.percentile_approx("doc_id", shares, 10000).alias("cuts"), F.max("doc_id").alias("most")).first()
    most = found["most"]
    cuts = np.array(sorted({x for x in found["cuts"] or [] if x is not None and x != most}), dtype=np.int64)

    @F.pandas_udf("int")
    def task(ids: pd.Series) -> pd.Series:
        given = ids.notna().to_numpy()
        return pd.Series(np.where(given, np.searchsorted(cuts, ids.fillna(0).to_numpy(np.int64), side="left"), 0)).astype("int32")

    own = F.struct(F.col("_task"), F.lit(0).alias("_tail"))
    above = F.when(F.col("doc_id").isin([int(x) for x in cuts]), F.array(F.struct((F.col("_task") + 1).alias("_task"), F.lit(1).alias("_tail")))) if len(cuts) else F.lit(None)
    around = F.when(F.col("doc_id").eqNullSafe(F.lit(most)), F.array(F.struct(F.lit(0).alias("_task"), F.lit(1).alias("_tail"))))
    empty = F.array().cast("array<struct<_task:int,_tail:int>>")
    places = F.concat(F.array(own), F.coalesce(above, empty), F.coalesce(around, empty))
    dealt = rows.withColumn("_task", task("doc_id")).select("doc_id", "text", F.explode(places).alias("_p"))
    dealt = dealt.select("doc_id", "text", "_p._task", "_p._tail")
    return dealt.repartitionById(len(cuts) + 1, F.col("_task")).sortWithinPartitions(
        "_task", "_tail", F.col("doc_id").desc_nulls_last(), "text"
    )


def fingerprints(docs: DataFrame, permutations: int = PERMUTATIONS) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with the likeness of both and of the next one.

    ``docs`` needs doc_id and text. Null text counts as empty; an empty text has the
    signature of the empty set, like only to itself. The order is descending doc_id, null
    ids last, rows of one id by text; of several such rows the first follows. Returned:
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    An empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(permutations)
        held = None  # text, id, signature of the own row that waits for its next one
        for batch in batches:
            _, offsets = buffers(batch.column("text"))
            ids, tail = (batch.column(x).to_pylist() for x in ("doc_id", "_tail"))
            for first, last in slices(offsets):
                texts = batch.column("text").slice(first, last - first).to_pylist()
                marks = texts_signatures([x.encode() for x in texts], hasher)
                done = []
                for k, text in enumerate(texts):
                    row = first + k
                    if held is not None:
                        done.append((held, (text, ids[row], marks[k])))
                        held = None
                    if not tail[row]:
                        held = (text, ids[row], marks[k])
                if done:
                    yield finished(done, hasher)

    def finished(done: list, hasher: MinHash) -> pa.RecordBatch:
        changed = [edited(a[0], b[0]).encode() for a, b in done]
        marks = texts_signatures(changed, hasher)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([a[1] for a, _ in done], pa.int64()),
                "n_chars": pa.array([len(a[0]) for a, _ in done], pa.int64()),
                "edited_sha256": [hashlib.sha256(x).hexdigest() for x in changed],
                "fingerprint": [written(a[2]) for a, _ in done],
                "edited_fingerprint": [written(x) for x in marks],
                "near_edited": pa.array([likeness(a[2], x) for (a, _), x in zip(done, marks)], pa.float64()),
                "near_next": pa.array([likeness(a[2], b[2]) for a, b in done], pa.float64()),
            }
        )

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return successors(docs).mapInArrow(tidy(run), schema)


def near_links(docs: DataFrame, threshold: float = 0.8, bands: int = BANDS, permutations: int = PERMUTATIONS) -> DataFrame:
    """Documents whose shingle sets have a Jaccard similarity of ``threshold`` or more.

    Signature bands are joined in Spark; the pairs that meet in a band are verified on
    the exact sets. One row for each document: doc_id, class_id (smallest doc_id of its
    linked group) and n_links. Texts without a word, null ones among them, have no links. Rows
    that repeat a doc_id or a text, and rows without doc_id, are documents like others; ties are
    links alike, an empty table gives an empty result, and other columns are ignored.
    """
    width = permutations // bands
    hasher = MinHash(permutations)

    def keys(values: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        marks = hasher.signatures(values, rows)
        return [links.band_keys(marks[i], bands, width) if rows[i + 1] > rows[i] else np.zeros(0, np.int64) for i in range(len(marks))]

    return links.resolve(docs, keys, threshold)


def near_links_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_links`` of all documents: doc_id, class_id, n_links."""
    return near_links(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fingerprints`` of all documents."""
    return fingerprints(documents(spark, sf_dir))
