"""Registered ordering query (O1, O2, S3, K6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsift import fixtures
from netsift.operators import ordering
from netsift.plans.common import FLOW_CTE, with_cte
from netsift.plans.registry import register


@register(
    "order_by_key",
    with_cte(FLOW_CTE) + """
SELECT key_text AS key, CAST(k % 3 AS INTEGER) AS partition, k AS "offset",
       row_number() OVER (ORDER BY encode(key_text), CAST(k % 3 AS INTEGER), k) AS pos
FROM flow""",
)
def order_by_key(spark, sf_dir):
    """O1 O2: bounded snapshot ordered by binary key (ties by partition, offset), with global position."""
    env = fixtures.flow_envelope(spark, sf_dir)
    ordered = ordering.order_by_key(env.select("key", "partition", "offset"))
    out = ordering.with_position(ordered)
    return out.select(F.col("key").cast("string").alias("key"), "partition", "offset", "pos")
