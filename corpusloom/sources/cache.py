"""Content that was fetched once and checked, reused as long as its revision and digest hold."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.contracts import ContractError
from corpusloom.streaming.state import Versions

SCHEMA = "id string, revision string, sha256 string, content binary"
ENTRY = ["id", "revision"]


def refuse(rows: DataFrame, what: str) -> None:
    """An error that names the first ids, if there are rows."""
    if found := rows.select("id").orderBy("id").limit(3).collect():
        raise ContractError(f"{what}: {', '.join(r['id'] for r in found)}")


def corrupt(entries: DataFrame) -> DataFrame:
    """Entries whose content isn't what their digest says; null content is corrupt."""
    return entries.where(F.coalesce(F.sha2("content", 256) != F.col("sha256"), F.lit(True)))


def cache_or_fetch(spark: SparkSession, wanted: DataFrame, path: str, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """id, revision, sha256, content, cached for every distinct row of ``wanted`` (id, revision; sha256, or null if it isn't known).

    Cached entries of an id and revision are reused; the others are fetched by ``fetch`` (rows of
    ``wanted`` to id, revision, sha256 or null, content). What is fetched is written, read again and
    checked against its own digest and the one asked for, and only then committed to the cache. A
    ContractError names entries that are corrupt, differ from what is asked for, were delivered
    twice or not at all, or lack id or revision; then nothing is committed.
    """
    asked = wanted.select(*(F.col(c).cast("string").alias(c) for c in ENTRY), F.col("sha256").cast("string").alias("asked")).distinct()
    if not asked.where("id is null or revision is null").isEmpty():
        raise ContractError("an entry without id or revision is asked for")
    cache = Versions(spark, path, SCHEMA)
    held = cache.read()
    refuse(corrupt(asked.join(held, ENTRY, "left_semi").join(held, ENTRY)), "corrupt in the cache")
    refuse(asked.join(held, ENTRY).where("asked <> sha256"), "cached with another digest")
    missing = asked.join(held.select(*ENTRY), ENTRY, "left_anti")
    if not missing.isEmpty():
        version = uuid.uuid4().hex
        got = fetch(missing.select(*ENTRY, F.col("asked").alias("sha256")))
        got.select(*ENTRY, F.coalesce("sha256", F.sha2("content", 256)).alias("sha256"), "content").write.parquet(f"{path}/versions/{version}")
        fresh = spark.read.schema(SCHEMA).parquet(f"{path}/versions/{version}")
        refuse(fresh.groupBy(*ENTRY).count().where("count > 1"), "delivered twice")
        refuse(missing.join(fresh, ENTRY, "left_anti"), "not delivered")
        refuse(fresh.join(missing, ENTRY, "left_anti"), "delivered without being asked for")
        refuse(corrupt(fresh), "delivered with another content than their digest")
        refuse(fresh.join(missing, ENTRY).where("asked <> sha256"), "delivered with another digest")
        cache.commit(version, 1 + max((c["number"] for c in cache.commits()), default=0), version, False)
    known = held.select(*ENTRY).distinct().withColumn("cached", F.lit(True))
    found = asked.select(*ENTRY).distinct().join(cache.read(), ENTRY).join(known, ENTRY, "left")
    return found.select("id", "revision", "sha256", "content", F.coalesce("cached", F.lit(False)).alias("cached"))
