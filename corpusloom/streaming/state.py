"""Durable tables that grow by committed versions, and state by key on top of them.

A version is a Parquet folder that nothing points to until its commit is written: one row in
one file, which Spark puts in place as a whole. What a crash leaves without a commit is never
read. A commit's name makes a step that is run again find itself done.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "step string, number bigint, version string, base boolean"


class Versions:
    """The committed versions of one table in a shared folder."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def commits(self) -> list:
        """All commits in order; one for each step, so their number is that of the steps."""
        try:
            rows = self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits").collect()
        except AnalysisException:  # no step has committed
            return []
        first: dict[str, object] = {}
        for row in sorted(rows, key=lambda r: (r["number"], r["version"])):
            first.setdefault(row["step"], row)  # of two runs of a step at once, one counts
        return list(first.values())

    def committed(self, step: str) -> bool:
        return any(c["step"] == step for c in self.commits())

    def write(self, rows: DataFrame, step: str, base: bool = False) -> bool:
        """Write and commit a version; False if the step has committed before. A ``base`` takes the place of all versions before it."""
        known = self.commits()
        if any(c["step"] == step for c in known):
            return False
        version = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/versions/{version}")
        self.commit(step, 1 + max((c["number"] for c in known), default=0), version, base)
        return True

    def commit(self, step: str, number: int, version: str, base: bool) -> None:
        self.spark.createDataFrame([(step, number, version, base)], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def read(self) -> DataFrame:
        """The rows of the last base and of all versions after it."""
        current: list[str] = []
        for c in self.commits():
            current = [c["version"]] if c["base"] else [*current, c["version"]]
        if not current:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/versions/{v}" for v in current))

    def since_base(self) -> int:
        """How many versions a reader merges."""
        n = 0
        for c in self.commits():
            n = 0 if c["base"] else n + 1
        return n


class KeyedState:
    """The last outcome of each key over any number of runs.

    Outcomes are rows (key, ok, value, error, seq). A key is done from its first success on: a
    later success replaces the value, which clears any failure, and a later failure changes
    nothing. Of outcomes of one step the largest ``seq`` is the last; equal ones are ordered by their
    value and error. Rows without key are no outcomes. Steps append what they know; ``compact`` folds
    all into one row a key.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "key", key_type: str = "string", value_type: str = "string", versions_at_most: int = 50):
        self.key, self.most = key, versions_at_most
        self.kinds = {key: key_type, "ok": "boolean", "value": value_type, "error": "string", "seq": "bigint", "step": "bigint", "tries": "bigint"}
        self.versions = Versions(spark, path, ", ".join(f"`{k}` {v}" for k, v in self.kinds.items()))

    def folded(self, rows: DataFrame) -> DataFrame:
        last = F.max(F.struct("ok", "step", "seq", "value", "error")).alias("m")  # a success before any failure, then the latest
        merged = rows.groupBy(self.key).agg(last, F.sum("tries").alias("tries"))
        return merged.select(self.key, *(F.col(f"m.{c}").alias(c) for c in ("ok", "value", "error", "seq", "step")), "tries").select(*self.kinds)

    def read(self) -> DataFrame:
        """key, done, value (of a success), error (of a failure), tries."""
        state = self.folded(self.versions.read())
        return state.select(self.key, F.col("ok").alias("done"), F.when(F.col("ok"), F.col("value")).alias("value"), F.when(~F.col("ok"), F.col("error")).alias("error"), "tries")

    def upsert(self, outcomes: DataFrame, number: int, writer: str = "main") -> bool:
        """Take over the outcomes of batch ``number`` of ``writer``; False if that batch has been taken over before."""
        columns = [F.col(c).cast(self.kinds[c]).alias(c) for c in (self.key, "ok", "value", "error", "seq")]
        rows = outcomes.where(F.col(self.key).isNotNull()).select(*columns).withColumn("ok", F.coalesce("ok", F.lit(False)))
        rows = rows.withColumns({"step": F.lit(number).cast("bigint"), "tries": F.lit(1).cast("bigint")}).select(*self.kinds)
        taken = self.versions.write(self.folded(rows), f"{writer}/{number}")
        if taken and self.versions.since_base() > self.most:
            self.compact()
        return taken

    def compact(self) -> None:
        """One version with one row a key instead of those so far; nothing changes for readers."""
        if known := self.versions.commits():
            self.versions.write(self.folded(self.versions.read()), f"compact/{known[-1]['number']}", base=True)

    def pending(self, rows: DataFrame, overwrite: bool = False) -> DataFrame:
        """Rows whose key isn't done; all of them if ``overwrite``. Rows without key never are."""
        if overwrite:
            return rows
        return rows.join(self.read().where("done").select(self.key), self.key, "left_anti")

    def reuse(self, rows: DataFrame, extract: Callable[[DataFrame], DataFrame], overwrite: bool = False) -> DataFrame:
        """(key, value, reused): the value of done keys, and what ``extract`` (rows to outcomes) makes of the others; failures give null."""
        fresh = extract(self.pending(rows, overwrite)).select(self.key, F.when(F.col("ok"), F.col("value")).alias("value"), F.lit(False).alias("reused"))
        if overwrite:
            return fresh
        done = self.read().where("done").join(rows.select(self.key).distinct(), self.key, "left_semi")
        return done.select(self.key, "value", F.lit(True).alias("reused")).unionByName(fresh)

    def progress(self, keys: DataFrame) -> DataFrame:
        """One row: n_keys, n_done, n_failed, complete; complete only if every distinct key is done."""
        wanted = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct().join(self.read(), self.key, "left")
        counts = wanted.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if("done").alias("n_done"), F.count_if(F.col("done") == F.lit(False)).alias("n_failed"))
        return counts.withColumn("complete", F.col("n_done") == F.col("n_keys"))


def run(stream: DataFrame, state: KeyedState, process: Callable[[DataFrame], DataFrame], checkpoint: str, writer: str) -> None:
    """Process what a stream has, and take every micro-batch's outcomes over once, whatever crashes in between.

    The batch's number in the stream's checkpoint is the commit's name, so that a batch which is
    run again after its commit changes nothing. ``writer`` names the stream; it must be another one
    if the checkpoint is new.
    """
    query = stream.writeStream.foreachBatch(lambda rows, number: state.upsert(process(rows), number, writer) and None).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def outcomes(rows: DataFrame, key: str, ok: Column, value: Column, error: Column, seq: Column) -> DataFrame:
    """Rows as outcomes of their keys."""
    return rows.select(F.col(key).alias(key), ok.alias("ok"), value.alias("value"), F.when(~ok, error).alias("error"), seq.alias("seq"))
