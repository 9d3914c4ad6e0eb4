"""The curation plan: normalise, gate, deduplicate; every input row ends with a decision and a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.unicode import composed
from corpusloom.operators.gates import Profile, exact_keep_first, first_reason, profile_gates
from corpusloom.operators.near import materialised


def decisions(docs: DataFrame, profile: Profile = Profile("general", 200, 0.35)) -> DataFrame:
    """doc_id, source, lang, text (normalised), reason (null if kept), duplicate_of.

    Gates come before deduplication: a rejected row never claims a key.
    """
    whole = composed(docs.select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text")), "text")
    clean = whole.withColumn("text", X.cleaned_lines(F.col("text")))
    gated = materialised(clean.withColumn("reason", first_reason(profile_gates(profile, F.col("text"), F.col("lang")))))  # cleaned once for all uses
    passed = exact_keep_first(gated.where("reason is null"), X.text_key(F.col("text")), "doc_id")
    rejected = gated.where("reason is not null").withColumn("duplicate_of", F.lit(None).cast("bigint"))
    return passed.withColumn("reason", F.when(F.col("duplicate_of").isNotNull(), "duplicate")).unionByName(rejected)


def kept(decided: DataFrame) -> DataFrame:
    """The canonical table of the rows that were kept."""
    rows = decided.where("reason is null")
    return rows.select(
        X.content_id(F.col("source"), X.text_key(F.col("text"))).alias("id"), "text", "source", F.lit("unknown").alias("created"), X.token_proxy(F.col("text")).alias("token_count")
    )
