"""Key-ordered snapshots of a record stream (O1, O2).

``order_by_key`` sorts a bounded topic snapshot by its (binary) key, with
``partition, offset`` breaking ties so the order is total and repeatable.
The scalable form range-partitions into ``n`` ordered ranges (a sampled range
exchange, then a local sort); partition ``i`` precedes partition ``i + 1``,
so writing the partitions in order gives one ordered sequence without ever
funnelling the data through a single task.

``with_position`` adds the global 1-based position without a global window:
the ordered ranges are checkpointed, each range counts its rows, and the
running sum of the ``n`` counts (a table of ``n`` rows) gives every range its
starting offset.

``single=True`` reproduces a one-partition output (sort, then merge into one
partition keeping order). It is one task by definition, for sinks that need a
single ordered partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsift.session import ensure_checkpoint_dir

TIE_BREAK = ("partition", "offset")


def order_columns(df: DataFrame, key: str = "key", tie_break: Sequence[str] = TIE_BREAK) -> list[str]:
    return [key, *[c for c in tie_break if c in df.columns]]


def order_by_key(
    df: DataFrame,
    key: str = "key",
    *,
    n_ranges: int | None = None,
    single: bool = False,
    tie_break: Sequence[str] = TIE_BREAK,
) -> DataFrame:
    """Globally ordered by ``key`` (ascending, NULLs first), then the tie-break columns."""
    cols = order_columns(df, key, tie_break)
    if single:
        return df.orderBy(*cols).coalesce(1)
    n = n_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)


def with_position(ordered: DataFrame, column: str = "pos") -> DataFrame:
    """Add the global 1-based position to the output of ``order_by_key``.

    The ordered ranges are checkpointed first, so partition numbers and row
    order within a partition are stable when the plan is read twice.
    """
    ensure_checkpoint_dir(ordered.sparkSession)
    fixed = ordered.checkpoint(eager=True)
    tagged = fixed.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_id"))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per range: the running sum is over n_ranges rows
    starts = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start")
    )
    local = F.col("_id") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    out = tagged.join(F.broadcast(starts), "_pid").withColumn(column, F.col("_start") + local + 1)
    return out.drop("_pid", "_id", "_start")


def write_ordered(df: DataFrame, path: str, fmt: str = "parquet", key: str = "key", **options) -> None:
    """Write key-ordered files: part ``i`` holds range ``i`` (K6 on a file sink)."""
    order_by_key(df, key).write.format(fmt).options(**options).mode("overwrite").save(path)
