"""Numbers in the order of a sort, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.near import materialised


def numbered(rows: DataFrame, *order: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: 1, 2, 3 ... in the given order.

    Range partitions are sorted by themselves; one count for each partition gives its offset.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    marked = materialised(sorted_rows.withColumn("_id", F.monotonically_increasing_id()))
    marked = marked.withColumns({"_part": F.shiftright("_id", 33), "_row": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    offsets, before = [], 0
    for part, count in sorted(marked.groupBy("_part").count().collect()):  # at most one row for each partition
        offsets.append((part, before))
        before += count
    table = rows.sparkSession.createDataFrame(offsets or [(0, 0)], "_part bigint, _before bigint")
    return marked.join(F.broadcast(table), "_part").withColumn(name, F.col("_row") + F.col("_before") + 1).drop("_id", "_part", "_row", "_before")
