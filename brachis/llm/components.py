"""Distributed connected components by alternating large-star and small-star steps.

Every step is two joins and two aggregations over the edge list: no adjacency list is built, so a hub with a third of
all edges is only a skewed join side, and the number of edges never grows. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, stage_table


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node reachable.

    Nodes may be of any orderable type. Self loops, repeated edges and rows with a null end are allowed and add nothing
    (a node with nothing but such edges is not returned). No edges give an empty result.
    """
    a, b = F.col(src), F.col(dst)
    plain = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(a.isNotNull() & b.isNotNull() & (a != b))
    now = stage_table(plain.distinct(), "edges")
    mark = _fingerprint(now)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage_table(large.distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage_table(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        was, mark = mark, _fingerprint(after)
        drop_table(large)
        drop_table(now)
        now = after
        if mark == was:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
