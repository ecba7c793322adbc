"""Connected components of an edge table: alternating large-star and small-star steps.

Every step is a min per node and a join back, so no node's neighbours meet in
one task. The minima are written before the join: both its sides then come straight from a
shuffle, and adaptive execution can split a hub's rows. Each round is written
with a reliable checkpoint; rounds grow with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    up = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = materialize(edges.groupBy("u").agg(F.min("v").alias("m")))
    rest = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of an edge but the roots themselves; root is the smallest node of the component.

    Null ends and loops are ignored; no edges give no rows.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    both = F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    now = materialize(edges.filter(both).select(high.alias("u"), low.alias("v")).distinct())
    state = _state(now)
    while state[0]:
        now = materialize(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
