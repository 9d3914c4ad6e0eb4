"""Operator 4, line dedup: a suffix array over line ids by distributed prefix doubling.

Every line that isn't blank is an id; a document is the sequence of its ids. Suffixes are
ranked by their first line, then by their first 2, 4, 8 ... lines: the rank by 2n lines is
the order of the pair (rank by n here, rank by n at n lines further on). Pairs are ordered
by a distributed range sort, so no task holds all suffixes of a common line. A suffix whose
prefix is unique, or runs into the end or a unique line, is done and leaves.

Suffixes of equal rank are an interval of the suffix array with a common prefix of that many
lines. The intervals are then refined from the deepest level down to single lines, which gives
each suffix its longest common prefix with any earlier one: the maximal repeated run that
begins there. Each suffix is one row throughout, however long its run is. Of the runs of a
document, those that end where an earlier one ends are parts of it; the others are deleted
if they have LEAST_WORDS words. So the earliest copy of each run stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.runtime import cut, documents, fitting, ordered_ids, small_side, unpacked
from corpusloom.llm.units import cut_out, lines, local, report, spans, texts_apart, variants, with_spans, without

#: Words of the shortest run that counts, whatever the number of its lines.
LEAST_WORDS = 5


def stripped(line: str) -> str:
    return line.strip()


def levels(docs: DataFrame, table: DataFrame | None = None) -> list[tuple[DataFrame, int]]:
    """The intervals by depth 1, 2, 4 ... and their number of rows: (doc_id, pos, rank, first), one row for each suffix
    that another one shares so many lines with; first (doc_id, pos) is the earliest of them."""
    all_lines = cut(lines(texts_apart(docs, table), stripped).drop("words").dropDuplicates(["doc_id", "pos"]))
    least = F.min(F.struct("doc_id", "pos")).alias("first")
    ids = ordered_ids(all_lines.groupBy("digest").agg(least, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), F.col("digest"), name="rank")
    level = cut(all_lines.join(ids, "digest").select("doc_id", "pos", "rank", "first"))
    depth, found = 1, []
    while rows := level.count():
        found.append((level, rows))
        ahead = small_side(level.select("doc_id", (F.col("pos") - depth).alias("pos"), F.col("rank").alias("then")), rows)
        both = cut(fitting(level.drop("first").join(ahead, ["doc_id", "pos"]), rows))
        pairs = both.groupBy("rank", "then").agg(least, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        named = small_side(ordered_ids(pairs, F.col("rank"), F.col("then"), name="next", most=rows // 2), rows)
        level = cut(fitting(both.join(named, ["rank", "then"]).select("doc_id", "pos", F.col("next").alias("rank"), "first"), rows))
        depth *= 2
    return found


def longest_earlier(found: list[tuple[DataFrame, int]]) -> DataFrame | None:
    """(doc_id, pos, n, src_doc, src_pos): for every suffix whose first line came before, the most lines that it
    shares with an earlier suffix, and the earliest suffix that shares them. None if no line repeats.

    A problem (src, n) is a set of suffixes that share n lines and of which no two share n + 2 ** level;
    src is its earliest. At each level its members are told apart by the rank of the lines from n on:
    those that aren't the earliest of equal ones have found a longer run and go on among these; the
    earliest ones go on among themselves. So each suffix is in one problem at a time.
    """
    now: DataFrame | None = None
    for level in reversed(range(len(found))):
        depth = 1 << level
        later = found[level][0].where("doc_id <> first.doc_id or pos <> first.pos")
        fresh = later.select("doc_id", "pos", F.lit(depth).alias("n"), F.col("first.doc_id").alias("src_doc"), F.col("first.pos").alias("src_pos"))
        if level + 1 < len(found):
            deeper = found[level + 1][0].where("doc_id <> first.doc_id or pos <> first.pos").select("doc_id", "pos")
            fresh = fresh.join(small_side(deeper, found[level + 1][1]), ["doc_id", "pos"], "left_anti")
        now = fresh if now is None else now.unionByName(fresh)
        if level:
            now = split(cut(fitting(now, found[level][1])), found[level][1], *found[level - 1], depth // 2)
    return now


def split(now: DataFrame, most: int, ranks: DataFrame, rows: int, step: int) -> DataFrame:
    """One level of ``longest_earlier`` over at most ``most`` suffixes: ``ranks``, of so many ``rows``, are those by ``step`` lines."""
    src = ["src_doc", "src_pos", "n"]
    heads = now.select(F.col("src_doc").alias("doc_id"), F.col("src_pos").alias("pos"), *src).distinct()
    heads = fitting(heads, most)
    there = small_side(ranks.select("doc_id", F.col("pos").alias("at"), "rank"), rows)
    every = now.select("doc_id", "pos", *src).unionByName(heads.select("doc_id", "pos", *src)).withColumn("at", F.col("pos") + F.col("n"))
    every = cut(fitting(every.join(there, ["doc_id", "at"], "left").drop("at"), 2 * most))
    groups = every.where("rank is not null").groupBy(*src, "rank").agg(F.min(F.struct("doc_id", "pos")).alias("head"), F.count(F.lit(1)).alias("members"))
    named = small_side(cut(fitting(groups.where("members > 1").drop("members"), most)), most)
    joined = every.where("doc_id <> src_doc or pos <> src_pos").join(named, [*src, "rank"], "left")
    on = F.col("head").isNotNull() & ((F.col("doc_id") != F.col("head.doc_id")) | (F.col("pos") != F.col("head.pos")))
    return joined.select(
        "doc_id", "pos", F.when(on, F.col("n") + step).otherwise(F.col("n")).alias("n"),
        F.when(on, F.col("head.doc_id")).otherwise(F.col("src_doc")).alias("src_doc"), F.when(on, F.col("head.pos")).otherwise(F.col("src_pos")).alias("src_pos"),
    )


def later_copies(docs: DataFrame, table: DataFrame | None) -> DataFrame:
    """doc_id, variant (of ``table``) and marks: pos and n (lines) of the runs in each text that came before."""
    found = longest_earlier(levels(docs, table))
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, variant int, marks array<struct<pos: int, n: int>>")
    return local(found, "pos", "n")


def without_runs(least_words: int) -> Callable[[str, list], tuple[str, list[tuple[int, int]]]]:
    """How the runs of ``later_copies`` are cut out of a text."""

    def remove(text: str, marks: list) -> tuple[str, list[tuple[int, int]]]:
        words = [len(line.split()) for _, _, line in spans(text)]
        dropped: set[int] = set()
        end = 0
        for pos, n in sorted((x["pos"], x["n"]) for x in marks):
            if pos + n > end:  # not a part of the run before
                end = min(pos + n, len(words))
                if sum(words[pos:end]) >= least_words:
                    dropped.update(range(pos, end))
        return without(text, dropped)

    return remove


def cleaned(docs: DataFrame, least_words: int) -> DataFrame:
    table = variants(docs)
    return cut_out(docs, table, later_copies(docs, table), without_runs(least_words))


def dedup_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated line runs cut from ``text``, and ``removed``: their spans.

    Lines are equal if they are without blanks at their ends; blank lines neither count nor
    break a run. A run counts from ``least_words`` words on, in one line or many. The earliest
    copy by (doc_id, position) stays, within a text too. Null and empty texts stay as they are; a text
    may become empty; very long texts are one row throughout. Rows that repeat a doc_id and its
    text count as one document and change alike; different texts of one doc_id are documents of
    their own, in the order of their digests; rows without doc_id aren't changed. An empty table gives an empty result; other columns are kept, but
    for one named ``removed``.
    """
    return with_spans(cleaned(docs, least_words), docs)


def dedup_documents(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` in its own columns with ``text`` cleaned as by ``dedup_runs`` and ``n_chars``, if there, set to its length.

    A document goes if every line of it was a later copy. Null, empty and blank texts stay as
    they are, and so does the ``n_chars`` of null; an empty table gives an empty result.
    """
    done = unpacked(cleaned(docs, least_words).where("not blank"), docs.columns)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))
    return done


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dedup_runs`` of all documents: doc_id, removed spans, their number and code points, length and SHA-256 of what stays."""
    return report(cleaned(documents(spark, sf_dir).select("doc_id", "text"), LEAST_WORDS))
