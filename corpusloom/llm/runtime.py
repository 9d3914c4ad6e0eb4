"""Helpers that every operator of the subpackage shares."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Most bytes of an Arrow batch, on either side of the pipe to a Python worker.
BATCH_BYTES = 1 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers: rows are whole texts, and the default batch holds 64 MB of them, as much again in the JVM beside its heap."""
    if int(spark.conf.get(_BATCH, f"{64 << 20}b").rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, BATCH_BYTES)


#: What modules keep in a worker process between tasks, and how each lets it go.
_held: dict[str, Callable[[], None]] = {}


def holds(name: str, forget: Callable[[], None]) -> None:
    """Tell that a module keeps something large in worker processes under ``name``."""
    _held[name] = forget


def let_go(keeps: str) -> None:
    """Forget all that modules keep in this process but for ``keeps``."""
    for name, forget in _held.items():
        if name != keeps:
            forget()


def give_back() -> None:
    """Give freed memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, which gives freed memory back to the system when a task ends: workers live on and wait beside the next ones.

    What other operators' tasks have left in the worker, but for ``keeps``, is let go and given back first.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from corpusloom.llm import runtime  # the worker's own module, not what travelled with this function

        runtime.let_go(keeps)
        runtime.give_back()
        yield from run(batches)
        runtime.give_back()

    return wrapped


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """One of the input tables."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where a session of one process has none, as in tests."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None and re.fullmatch(r"local(\[.*\])?", context.master) is None:
            raise RuntimeError("spark.checkpoint.dir is unset; executors need a folder that they share")
        context.setCheckpointDir(where or tempfile.mkdtemp(prefix="corpusloom-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder, which survives lost executors.

    A checkpoint keeps the size that was estimated for its plan. Joins multiply estimates, so
    in loops they double their digits with each round; the rows are taken up anew without one,
    and adaptive execution goes by the sizes it meets.
    """
    spark = df.sparkSession
    shared_folder(spark)
    done = df.checkpoint(eager=True)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(done.queryExecution().toRdd(), done.schema(), False), spark)


#: Most rows of a table of a few numbers each (about 3 MB) that is broadcast.
BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, most: int | None = None) -> DataFrame:
    """A table of keys and numbers, broadcast if it is small, else as it is.

    ``most`` bounds its rows; without it a materialised table is counted.
    """
    return F.broadcast(df) if (df.count() if most is None else most) <= BROADCAST_ROWS else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that a later step reads."""
    return f"{shared_folder(spark)}/{name.replace(' ', '_')}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: smaller than a checkpoint, and read by columns.

    The shuffle files of the write go when it ends, not when the driver happens to collect its garbage.
    """
    spark, where = df.sparkSession, scratch(df.sparkSession, name)
    held = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(where)
    finally:
        spark.conf.set(_CLEANUP, held)
    return spark.read.parquet(where)


def parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def whole_number(column: str | Column) -> Column:
    """A document id as bigint."""
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def quoted(name: str) -> str:
    """A column name for expressions, whatever it contains."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct, so that helper columns beside it can't clash with their names."""
    return F.struct(*(F.col(quoted(c)) for c in df.columns))


def unpacked(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns of a ``whole_row`` named row."""
    return df.select(*(F.col("row").getField(c).alias(c) for c in names))


#: Rows of a few numbers each that make a task of their own.
TASK_ROWS = 20_000


def fitting(df: DataFrame, most: int) -> DataFrame:
    """``df``, of at most so many rows of a few numbers, in no more partitions than they need."""
    few = max(1, -(-most // TASK_ROWS))
    return df.coalesce(few) if few < parts(df.sparkSession) else df


def ordered_ids(df: DataFrame, *order: Column, name: str, most: int | None = None) -> DataFrame:
    """``df`` with a bigint ``name`` that grows with ``order``; gaps are allowed.

    Range partitions hold increasing keys, and ``monotonically_increasing_id`` grows
    with the partition and with the row inside it, so no task sees all rows, unless they
    are known to be at most ``most``, which one task sorts.
    """
    n = parts(df.sparkSession)
    if most is not None and most <= TASK_ROWS:
        return cut(df.coalesce(1).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return cut(ranged.withColumn(name, F.monotonically_increasing_id()))


def dense_ids(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """As ``ordered_ids``, but the numbers are 0, 1, 2 and so on without gaps.

    Only one row for each range partition travels to the offsets.
    """
    low = (1 << 33) - 1
    gaps = ordered_ids(df, *order, name="_gap").withColumns(
        {"_part": F.shiftright("_gap", 33), "_row": F.col("_gap").bitwiseAND(F.lit(low))}
    )
    sizes = sorted(gaps.groupBy("_part").count().collect())
    before, offsets = 0, []
    for part, n in sizes:  # one entry for each partition, a number the session fixes
        offsets.append((part, before))
        before += n
    numbers = [pa.array(x, pa.int64()) for x in zip(*(offsets or [(0, 0)]))]
    # From Arrow: a list would go through Python workers of another kind, which then stay beside those of the operators.
    table = df.sparkSession.createDataFrame(pa.Table.from_arrays(numbers, ["_part", "_before"]))
    return gaps.join(F.broadcast(table), "_part").withColumn(name, F.col("_row") + F.col("_before")).drop(
        "_part", "_row", "_before", "_gap"
    )
