"""Checks that fail a job, and comparisons of tables with what they should be."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A table breaks a rule that the job depends on."""


def missing_columns(rows: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns that the table lacks, in the given order."""
    return [c for c in required if c not in rows.columns]


def require_columns(rows: DataFrame, required: Iterable[str]) -> DataFrame:
    if lacking := missing_columns(rows, required):
        raise ContractError(f"missing columns: {', '.join(lacking)}")
    return rows


def without_private(rows: DataFrame, private: Iterable[str]) -> DataFrame:
    """The table without private columns, whatever their case; none is left."""
    hidden = {c.lower() for c in private}
    return rows.select(*(F.col("`" + c.replace("`", "``") + "`") for c in rows.columns if c.lower() not in hidden))


def require_public(rows: DataFrame, private: Iterable[str]) -> DataFrame:
    hidden = {c.lower() for c in private}
    if found := [c for c in rows.columns if c.lower() in hidden]:
        raise ContractError(f"private columns: {', '.join(found)}")
    return rows


def require(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``rows``, if every rule holds for every row (null fails); one pass counts what breaks each rule."""
    if not rules:
        return rows
    counts = rows.agg(*(F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"r{k}") for k, rule in enumerate(rules.values()))).first()
    if broken := [f"{name}: {n} rows" for name, n in zip(rules, counts) if n]:
        raise ContractError("; ".join(broken))
    return rows


def strict_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The inner join; an error if a row of ``left`` has no partner or a key of ``right`` repeats."""
    repeated = right.groupBy(key).count().where("count > 1")
    if not repeated.isEmpty():
        raise ContractError(f"{key} repeats on the right")
    alone = left.join(right.select(key), key, "left_anti")
    if not alone.isEmpty():
        raise ContractError(f"{key} has no partner")
    return left.join(right, key)


def registry_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key and change (added, removed or changed) of the entries that differ; equal ones give no row.

    Entries are compared in all other columns of either table, null equal to null and to a column that
    a table lacks; keys are unique and not null.
    """
    others = [c for c in dict.fromkeys(before.columns + after.columns) if c != key]
    kinds = dict(after.dtypes) | dict(before.dtypes)

    def entry(rows: DataFrame) -> Column:
        return F.struct(F.lit(1).alias("_there"), *(F.col(c) if c in rows.columns else F.lit(None).cast(kinds[c]).alias(c) for c in others))

    held = [x.select(key, entry(x).alias(side)) for x, side in ((before, "_old"), (after, "_new"))]
    both = held[0].join(held[1], key, "full")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    return both.select(key, change.alias("change")).where("change is not null")


def counter_totals(rows: DataFrame, counters: str) -> DataFrame:
    """key, total: the sums of a column of maps by key."""
    return rows.select(F.explode(counters).alias("key", "value")).groupBy("key").agg(F.sum("value").alias("total"))
