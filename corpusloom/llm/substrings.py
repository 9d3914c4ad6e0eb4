"""Operator 2, substring dedup: a passage is a unit of PASSAGE words, wherever in a line it begins or ends.

Units are normalised, their digests are grouped over all documents, the earliest by (doc_id,
position) is kept and the rest are removed, with their offsets in the original. The text is
cut into units at every word, so that a passage is met whatever is before and behind it;
whole lines or paragraphs as units would miss those that begin or end inside a line.

There is no row for each unit. The smallest hash of the GRAM-word runs inside a unit depends on
its words alone, so equal units have equal ones. Neighbouring units with the same smallest run are
one segment, and segments are grouped by their digest first. Where distinct segments have an equal
smallest run, the first copy of each is opened, and its units are grouped by their own digests.
Both steps together remove what grouping all units would; a test holds them against that.
Groups are aggregated before they are joined, so a very common passage is no hot key.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.blocks import U, buffers, mix, slices, words
from corpusloom.llm.runtime import BROADCAST_ROWS, documents, small_side, stored, tidy
from corpusloom.llm.units import APART, cut_out, local, report, texts_apart, variants, with_spans

PASSAGE = 50
GRAM = 20
#: Multipliers of the hashes of short runs, segments and windows.
RUN, SEGMENT, WINDOW = 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1342543DE82EF95
WORD = re.compile(r"\S+")


def normal(text: str) -> str:
    """A text in the form in which it is compared: NFC, lower case, blanks collapsed."""
    return " ".join(unicodedata.normalize("NFC", text).lower().split())


class Rolling:
    """Hashes of any runs of words, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, hashes: np.ndarray, base: int):
        n = len(hashes)
        self.back = self.powers(pow(base, -1, 1 << 64), n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.powers(base, n), dtype=np.uint64)])

    @staticmethod
    def powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[:1] = U(1)
        return np.multiply.accumulate(out)

    def runs(self, begin: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[begin + length] - self.sums[begin]) * self.back[begin])


def smallest(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest of every ``width`` neighbouring values, and the last place where it is."""
    place, length = np.arange(len(values)), 1
    while length < width:
        step = min(length, width - length)
        take = values[step:] <= values[: len(values) - step]
        values = np.where(take, values[step:], values[: len(values) - step])
        place = np.where(take, place[step:], place[: len(place) - step])
        length += step
    return values, place


def segments(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first window (from 0 in its row), windows, smallest run and hash of every segment."""
    if len(hashes) < PASSAGE:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    least, place = smallest(Rolling(hashes, RUN).runs(np.arange(len(hashes) - GRAM + 1), GRAM), PASSAGE - GRAM + 1)
    inside = np.flatnonzero(owner[: len(least)] == owner[PASSAGE - 1 :])
    if not len(inside):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    new = np.ones(len(inside), dtype=bool)
    new[1:] = (place[inside[1:]] != place[inside[:-1]]) | (owner[inside[1:]] != owner[inside[:-1]])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(inside)))
    begin = inside[at]
    marks = mix(Rolling(hashes, SEGMENT).runs(begin, count + PASSAGE - 1) ^ count.astype(np.uint64))
    return owner[begin], begin - rows[owner[begin]], count, least[begin].view(np.int64), marks.view(np.int64)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in the form in which they are compared, and the texts' offsets."""
    return words(*buffers(pa.array([normal(x) for x in texts], pa.large_string())))


def all_segments(docs: DataFrame) -> DataFrame:
    """One row for each segment of each text: least, mark, doc_id, begin (first window), n (windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = buffers(batch.column("text"))
            ids = np.array(batch.column("doc_id").to_pylist(), dtype=np.int64)
            base = np.array(batch.column("variant").to_pylist(), dtype=np.int64) * APART
            for first, last in slices(offsets):
                row, begin, count, least, mark = segments(*word_hashes(batch.column("text").slice(first, last - first).to_pylist()))
                for k in range(0, len(row), 50_000):
                    part = slice(k, k + 50_000)
                    columns = (least[part], mark[part], ids[first + row[part]], begin[part] + base[first + row[part]], count[part].astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["least", "mark", "doc_id", "begin", "n"])

    return docs.mapInArrow(tidy(run), "least bigint, mark bigint, doc_id bigint, begin bigint, n int")


def later(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, begin, n) of the ``units`` that aren't the first of equal (least, mark), and one row for each of these: least, doc_id, begin, n."""
    groups = units.groupBy("least", "mark").agg(F.min(F.struct("doc_id", "begin", "n")).alias("first"), F.count(F.lit(1)).alias("members"))
    groups = stored(groups, "groups")
    many = groups.where("members > 1").select("least", "mark", "first")
    found = units.join(many, ["least", "mark"]).where("doc_id <> first.doc_id or begin <> first.begin")
    return found.select("doc_id", "begin", "n"), groups.select("least", "first.*")


def opened_windows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The windows of the ``chosen`` segments: least, mark (now of the window), doc_id, begin, n (1)."""
    key = ["doc_id", "variant"]
    placed = chosen.select("doc_id", F.shiftright("begin", 32).cast("int").alias("variant"), F.struct(F.col("begin").bitwiseAND(F.lit(APART - 1)).alias("begin"), "n", "least").alias("x"))
    lists = stored(placed.groupBy(*key).agg(F.collect_set("x").alias("chosen")), "lists")
    if lists.count() <= BROADCAST_ROWS:  # then the other texts needn't move
        docs = docs.join(F.broadcast(lists.select(*key)), key, "left_semi")
    wide = lists.join(docs, key).select(*key, "chosen", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, variant, chosen, text in zip(*(batch.column(c).to_pylist() for c in (*key, "chosen", "text"))):
                hashes, _ = word_hashes([text])
                begin, count, least = (np.array([x[c] for x in chosen], dtype=np.int64) for c in ("begin", "n", "least"))
                at = np.repeat(begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                least = np.repeat(least, count)
                fits = at + PASSAGE <= len(hashes)
                at, least = at[fits], least[fits]
                if len(at):
                    marks = Rolling(hashes, WINDOW).runs(at, PASSAGE).view(np.int64)
                    columns = (least, marks, np.full(len(at), doc_id, np.int64), at + variant * APART, np.ones(len(at), np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["least", "mark", "doc_id", "begin", "n"])

    return wide.mapInArrow(tidy(run), "least bigint, mark bigint, doc_id bigint, begin bigint, n int")


def later_passages(docs: DataFrame, table: DataFrame | None) -> DataFrame:
    """doc_id, variant and marks (begin, n): where the units begin that equal an earlier one by (doc_id, variant, position)."""
    rows = texts_apart(docs, table)
    every = stored(all_segments(rows), "segments")
    often = stored(every.groupBy("least").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("least"), "often")
    found, firsts = later(stored(every.join(small_side(often), "least").select("least", "mark", "doc_id", "begin", "n"), "units"))
    shared = stored(firsts.groupBy("least").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("least"), "shared")
    single, _ = later(stored(opened_windows(rows, firsts.join(small_side(shared), "least")), "windows"))
    return local(found.unionByName(single), "begin", "n")


def without_words(text: str, marks: list) -> tuple[str, list[tuple[int, int]]]:
    """``text`` without the units of the given marks, and the spans taken out, in code points."""
    found = [m.span() for m in WORD.finditer(text)]
    spans: list[list[int]] = []  # of words
    for begin, n in sorted((x["begin"], x["n"]) for x in marks):
        end = min(begin + n - 1 + PASSAGE, len(found))
        if spans and begin <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        elif begin < end:
            spans.append([begin, end])
    gone = [(found[a][0], found[b - 1][1]) for a, b in spans]
    edges = [0, *(x for span in gone for x in span), len(text)]
    return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), gone


def dedup_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``, and ``removed``: their spans in the original.

    Words are what blanks separate, equal in NFC and lower case; line feeds are blanks. Every
    run of PASSAGE words that equals an earlier one, by (doc_id, position), goes, within a text
    too; the blanks on both sides of a span stay. Null, empty and shorter texts stay as they are; a text
    may become empty. Rows that repeat a doc_id and its text count as one document and change alike;
    different texts of one doc_id are documents of their own, in the order of their digests; rows
    without doc_id aren't changed. An empty table gives an empty result; other columns are kept,
    but for one named ``removed``.
    """
    table = variants(docs)
    return with_spans(cut_out(docs, table, later_passages(docs, table), without_words), docs)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dedup_passages`` of all documents: doc_id, removed spans, their number and code points, length and SHA-256 of what stays."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    table = variants(docs)
    return report(cut_out(docs, table, later_passages(docs, table), without_words))
