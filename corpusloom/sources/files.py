"""Readers and writers for the formats of a curation run; schemas are always given, never inferred.

Paths are what Spark reads and writes: folders of part files, in any file system it knows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANONICAL = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "text", "source", "added", "created")] + [T.StructField("token_count", T.LongType())] + [T.StructField(n, T.StringType()) for n in ("license", "author")])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _path(spark: SparkSession, path: str):
    """A path and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _path(spark, path)
    return system.exists(where)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A UTF-8 CSV with a header, all columns text; a missing file gives no rows.

    A byte-order mark before the header is harmless, as names are given.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", True).option("escape", '"').csv(path).na.fill("")


def read_csv_union(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """The rows of those files that there are, with the file as ``origin``."""
    found = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "origin"]]))
    for path in paths:
        found = found.unionByName(read_csv(spark, path, columns).withColumn("origin", F.lit(path)))
    return found


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines, plain or gzip; empty lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files of one JSON document each, in the fields of the schema only; the items of an array are rows."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """path, text: whole files, with broken UTF-8 replaced."""

    @F.pandas_udf("string")
    def decoded(raw):
        return raw.map(lambda x: bytes(x).decode("utf-8", "replace"))

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", decoded("content").alias("text"))


def texts_of(rows: DataFrame, path: str, name: str) -> DataFrame:
    """``rows`` with ``text``, the file below ``path`` of the relative name in the column ``name``; empty if there is none."""
    files = read_text_files(rows.sparkSession, path)
    root = path.rstrip("/") + "/"
    own = files.select(F.substring_index("path", root, -1).alias("_name"), F.col("text").alias("_text"))
    wide = rows.select(F.struct(*rows.columns).alias("_row"), F.col(name).alias("_name")).join(own, "_name", "left")
    return wide.select("_row.*", F.coalesce("_text", F.lit("")).alias("text"))


def read_checksums(spark: SparkSession, path: str, without: tuple[str, ...] = ()) -> DataFrame:
    """path (below ``path``), bytes, sha256 of every file but those in ``__pycache__`` or of the names ``without``, in order of paths."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = files.where(~F.col("path").contains("/__pycache__/") & ~F.substring_index("path", "/", -1).isin(*without))
    root = path.rstrip("/") + "/"
    return files.select(F.substring_index("path", root, -1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).orderBy("path")


def checksum_differences(here: DataFrame, there: DataFrame) -> DataFrame:
    """path, change: files of both with other bytes (changed), and those of one side (added to, or removed from, ``there``)."""
    both = here.select("path", F.col("sha256").alias("a")).join(there.select("path", F.col("sha256").alias("b")), "path", "full")
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return both.select("path", change.alias("change")).where("change is not null")


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the one with the largest ``order``."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("_r")).select("_r.*")


def write_table(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with zstd."""
    rows.write.mode(mode).option("compression", "zstd").parquet(path)


def write_canonical(rows: DataFrame, path: str) -> None:
    """As ``write_table`` with the columns and types of ``CANONICAL``; a lacking or further column is an error."""
    if set(rows.columns) != set(CANONICAL.names):
        raise ValueError(f"columns {sorted(rows.columns)}; expected {sorted(CANONICAL.names)}")
    write_table(rows.select(*(F.col(f.name).cast(f.dataType) for f in CANONICAL)), path)


def write_jsonl(rows: DataFrame, path: str, compress: bool = False) -> None:
    """JSON lines with keys in alphabetical order and nulls written."""
    ordered = rows.select(*sorted(rows.columns))
    ordered.write.option("ignoreNullFields", False).option("compression", "gzip" if compress else "none").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.option("header", True).option("escape", '"').csv(path)


def replace_csv(rows: DataFrame, path: str) -> None:
    """Write beside ``path`` first, keep what was there as ``path``.bak, then take its place; ``rows`` may come from ``path``."""
    spark = rows.sparkSession
    fresh = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    write_csv(rows, fresh)
    (old, system), (new, _), (backup, _) = (_path(spark, x) for x in (path, fresh, f"{path.rstrip('/')}.bak"))
    if system.exists(old):
        system.delete(backup, True)
        if not system.rename(old, backup):
            raise OSError(f"{path} can't be moved")
    if not system.rename(new, old):
        raise OSError(f"{fresh} can't be moved")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text as one file, which replaces one that is there."""
    where, system = _path(spark, path)
    out = system.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_json_document(spark: SparkSession, value, path: str) -> None:
    """A small value, such as a report's one row, as JSON with sorted keys."""
    write_text(spark, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n", path)


def markdown_table(rows: DataFrame, title: str, most: int = 1000) -> str:
    """A report of aggregated rows, in their order; more than ``most`` are an error, as the driver holds them."""
    found = rows.take(most + 1)
    if len(found) > most:
        raise ValueError(f"more than {most} rows")
    cells = [list(rows.columns), ["---"] * len(rows.columns), *(["" if x is None else str(x).replace("|", "\\|").replace("\n", " ") for x in row] for row in found)]
    return f"# {title}\n\n" + "".join("| " + " | ".join(row) + " |\n" for row in cells)


def write_checksums(files: DataFrame, path: str) -> None:
    files.select(F.concat_ws("  ", "sha256", "path").alias("value")).write.text(path)
