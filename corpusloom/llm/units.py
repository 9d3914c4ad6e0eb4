"""Texts as sequences of lines: digests, original offsets, and cutting lines out again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.runtime import cut, small_side, tidy, whole_number, whole_row

#: Positions of a text are counted from its variant's number times this.
APART = 1 << 32


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def variants(docs: DataFrame) -> DataFrame | None:
    """doc_id, digest, variant (from 1): the texts after the first, by digest, of each doc_id that repeats with different ones; None if there are none.

    Rows are told apart by doc_id and text, so that no text is changed for what another of its id holds.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select(whole_number("doc_id").alias("doc_id"), _digest(F.col("text")).alias("digest"))
    many = cut(rows.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("z")).where("a <> z").select("doc_id"))
    if many.isEmpty():
        return None
    texts = rows.join(small_side(many), "doc_id").distinct()
    numbered = texts.withColumn("variant", F.row_number().over(Window.partitionBy("doc_id").orderBy("digest")) - 1)
    return cut(numbered.where("variant > 0"))


def with_variant(rows: DataFrame, table: DataFrame | None, doc_id: Column, text: Column) -> DataFrame:
    """``rows`` with ``variant`` from the ``variants`` of their table."""
    if table is None:
        return rows.withColumn("variant", F.lit(0))
    other = small_side(table.select(F.col("doc_id").alias("_of"), F.col("digest").alias("_digest"), "variant"))
    met = rows.join(other, (doc_id.cast("bigint") == F.col("_of")) & (_digest(text) == F.col("_digest")), "left").drop("_of", "_digest")
    return met.withColumn("variant", F.coalesce("variant", F.lit(0)))


def texts_apart(docs: DataFrame, table: DataFrame | None) -> DataFrame:
    """doc_id, text (null as empty) and variant of the rows with doc_id."""
    rows = docs.where(F.col("doc_id").isNotNull()).select(whole_number("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return with_variant(rows, table, F.col("doc_id"), F.col("text"))


def local(marks: DataFrame, *columns: str) -> DataFrame:
    """``marks`` of positions (the first of ``columns``) by text: doc_id, variant and an array ``marks`` of places within the text."""
    place, *others = columns
    within = F.struct(F.col(place).bitwiseAND(F.lit(APART - 1)).cast("int").alias(place), *(F.col(c).cast("int").alias(c) for c in others))
    return marks.groupBy("doc_id", F.shiftright(place, 32).cast("int").alias("variant")).agg(F.collect_set(within).alias("marks"))


def spans(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and content of each line that isn't blank, in code points, without the line feed."""
    begin = 0
    for line in text.split("\n"):
        end = begin + len(line)
        if line and not line.isspace():
            yield begin, end, line
        begin = end + 1


def digest(unit: str) -> bytes:
    return hashlib.blake2b(unit.encode(), digest_size=16).digest()


def lines(docs: DataFrame, normalise) -> DataFrame:
    """One row for each line that isn't blank of ``texts_apart``: doc_id, pos (from APART times the variant), digest, words.

    ``normalise`` maps a line to the form in which lines are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out: list[tuple] = []
            for doc_id, variant, text in zip(ids, batch.column("variant").to_pylist(), batch.column("text")):
                for pos, (_, _, line) in enumerate(spans(text.as_py()), variant * APART):
                    unit = normalise(line)
                    out.append((doc_id, pos, digest(unit), len(unit.split())))
                if len(out) >= 50_000:
                    yield table(out)
                    out = []
            if out:
                yield table(out)

    def table(out: list[tuple]) -> pa.RecordBatch:
        a, b, c, d = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.binary()), pa.array(d, pa.int32())], ["doc_id", "pos", "digest", "words"])

    return docs.mapInArrow(tidy(run), "doc_id bigint, pos bigint, digest binary, words int")


def without(text: str, dropped: set[int]) -> tuple[str, list[tuple[int, int]]]:
    """``text`` without the lines of the given positions, and their spans in the original."""
    out, gone = [], []
    pos = begin = 0
    for line in text.split("\n"):
        end = begin + len(line)
        if line and not line.isspace():
            if pos in dropped:
                gone.append((begin, end))
            else:
                out.append(line)
            pos += 1
        else:
            out.append(line)
        begin = end + 1
    return ("\n".join(out) if gone else text), gone


def span_text(removed: Column) -> Column:
    """The spans as text, begin-end joined by commas; empty if there are none."""
    written = F.transform(removed, lambda s: F.concat_ws("-", s["begin"].cast("string"), s["end"].cast("string")))
    return F.coalesce(F.array_join(written, ","), F.lit(""))


def cut_out(docs: DataFrame, table: DataFrame | None, marks: DataFrame, remove: Callable[[str, list], tuple[str, list[tuple[int, int]]]]) -> DataFrame:
    """``row`` (all columns of ``docs``, with cleaned text), ``removed`` (spans taken out, or null) and ``blank``.

    ``marks`` has doc_id, variant (of ``table``) and an array ``marks``, one row for each text to change; ``remove`` maps a
    text and its marks to the cleaned text and the spans in the original. ``blank`` tells texts that
    became empty or blank. The columns of ``docs`` travel in one struct, so their names can't clash.
    """
    keyed = marks.select(F.col("doc_id").alias("_id"), F.col("variant").alias("_which"), F.col("marks").alias("_marks"))
    held = docs.select(F.col("doc_id").cast("bigint").alias("_own"), whole_row(docs).alias("row"))
    held = with_variant(held, table, F.col("_own"), F.col("row.text"))
    wide = held.join(keyed, (F.col("_own") == F.col("_id")) & (F.col("variant") == F.col("_which")), "left").select("row", "_marks")
    span = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([T.StructField("row", wide.schema["row"].dataType), T.StructField("removed", T.ArrayType(span)), T.StructField("blank", T.BooleanType())])
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            fields = rows.flatten()
            texts, gone, blank = [], [], []
            for text, own in zip(fields[at].to_pylist(), batch.column("_marks").to_pylist()):
                spent: list[tuple[int, int]] = []
                if own and text:
                    text, spent = remove(text, own)
                gone.append([{"begin": a, "end": b} for a, b in spent] if spent else None)
                blank.append(bool(spent) and not text.strip())
                texts.append(text)
            fields[at] = pa.array(texts, fields[at].type)
            whole = pa.StructArray.from_arrays(fields, fields=list(rows.type))
            yield pa.RecordBatch.from_arrays([whole, pa.array(gone, kind), pa.array(blank)], ["row", "removed", "blank"])

    return wide.mapInArrow(tidy(run), schema)


def with_spans(done: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` and ``removed``, which takes the place of a column of that name."""
    return done.select(*(F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() != "removed"), "removed")


def report(done: DataFrame) -> DataFrame:
    """doc_id, removed spans, their number and code points, and the cleaned text's length and SHA-256."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return done.select(
        F.col("row.doc_id").alias("doc_id"),
        F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed")).alias("n_removed"),
        F.expr("coalesce(aggregate(removed, 0, (n, s) -> n + s.end - s.begin), 0)").alias("chars_removed"),
        span_text(F.col("removed")).alias("removed_spans"),
        F.length(text).cast("bigint").alias("n_chars"),
        F.sha2(text, 256).alias("text_sha256"),
    )
