"""Parts of a snapshot: partition folders and file patterns, pruned before anything is listed or read."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that a Hadoop path pattern gives a meaning.
_SPECIAL = re.compile(r"([{}\[\]*?\\^,])")


def literal(name: str) -> str:
    """A folder's name as a pattern that matches it alone."""
    return _SPECIAL.sub(r"\\\1", name)


def one_of(values: Iterable[str]) -> str:
    return "{" + ",".join(values) + "}"


def files(spark: SparkSession, root: str, folders: Sequence[str], patterns: Sequence[str]) -> DataFrame:
    """path, modificationTime, length, content of the files right in ``folders`` of ``root`` whose names match one of ``patterns``.

    Folders that aren't asked for aren't listed and files that don't match aren't opened; a folder
    that doesn't exist gives nothing, and neither do no folders or patterns. Files come once, whatever
    patterns they match.
    """
    wanted = sorted(set(folders)) if patterns else []
    if not wanted:
        return spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary")
    there = [w for w in wanted if _exists(spark, f"{root}/{literal(w)}")]
    if not there:
        return files(spark, root, [], patterns)
    return spark.read.format("binaryFile").option("pathGlobFilter", one_of(sorted(set(patterns)))).load([f"{root}/{literal(w)}" for w in there])


def _exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a folder is there, as Spark's reader sees it."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").load(pattern)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return False
    return True


def pull(spark: SparkSession, root: str, batches: Sequence[str], patterns: Sequence[str]) -> DataFrame:
    """batch, name, length, sha256, content: the files of each batch's folder that match a pattern."""
    found = files(spark, root, batches, patterns)
    parts = F.split("path", "/")
    return found.select(F.element_at(parts, -2).alias("batch"), F.element_at(parts, -1).alias("name"), "length", F.sha2("content", 256).alias("sha256"), "content")


def partitions(spark: SparkSession, root: str, schema: str, **values: Sequence[object]) -> DataFrame:
    """A partitioned Parquet table, restricted to partition values: ``partitions(spark, root, schema, year=[2025], kind=["a"])``.

    The restriction is on partition columns alone, so that Spark drops folders before it reads any file.
    """
    rows = spark.read.schema(schema).parquet(root)
    for column, allowed in values.items():
        rows = rows.where(F.col(column).isin(*allowed) if allowed else F.lit(False))
    return rows


def matches(name: str, patterns: Iterable[str]) -> bool:
    """What ``patterns`` mean for a name, for tests and messages."""
    return any(fnmatchcase(name, p) for p in patterns)
