"""Large buckets: a group of near copies leaves with one of its own."""

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import links


def sketches():
    """Node 0, like no other, and 1200 near copies of one sketch, all in one bucket; node, sketch."""
    draw = np.random.default_rng(5)
    base = draw.integers(0, 256, links.SKETCH, dtype=np.uint8)
    rows = [(0, draw.integers(0, 256, links.SKETCH, dtype=np.uint8).tobytes())]
    for k in range(1, 1201):
        own = base.copy()
        own[draw.integers(0, links.SKETCH, 4)] = draw.integers(0, 256, 4, dtype=np.uint8)
        rows.append((k, own.tobytes()))
    return rows


def bucket(spark):
    return spark.createDataFrame([(7, k, 100, bytearray(x)) for k, x in sketches()], "bucket bigint, node bigint, size bigint, sketch binary").repartition(4)


def test_near_copies_leave_a_bucket_whose_smallest_node_is_another(spark):
    left = bucket(spark)
    edges, rest = links.strip(left, left.select("node", "size", "sketch"), 0.8)
    assert rest.count() <= 1
    pairs = edges[0]
    for more in edges[1:]:
        pairs = pairs.union(more)
    groups = {r["node"]: r["root"] for r in links.components(pairs).collect()}
    assert len({groups[k] for k in range(1, 1201)}) == 1 and 0 not in groups


def test_blocks_of_small_and_large_buckets_are_all_compared(spark):
    few = bucket(spark).where("node <= 400")
    many = bucket(spark).where("node > 350").withColumn("bucket", F.lit(8).cast("bigint"))
    groups = {r["node"]: r["root"] for r in links.components(links.block_edges(few.union(many), 0.8)).collect()}
    assert len({groups[k] for k in range(1, 1201)}) == 1 and 0 not in groups
