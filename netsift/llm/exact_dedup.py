"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups.

DataFrame functions only. The first aggregation groups by ``(hash, text)``:
the text itself is part of the grouping key, so two texts share a class only
when their bytes are equal, and the map-side combine leaves one row per task
and distinct text however many copies there are. What follows carries hashes,
not texts. Rows find their class by the hash alone unless some hash stands for
two texts; those hashes, if any, are matched on the text.

Defined results: a null text counts as empty, and all empty texts are equal.
A null id never becomes ``keep_id`` unless a whole class has no id; its row is
returned with ``kept`` false. Rows repeating an id and its text count as
members, and all rows of the class that carry its smallest id (a tie) are kept.
A very long text is hashed and compared whole. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.llm.common import SPACE, columns_as, materialize


def normalized(text: Column) -> Column:
    """White-space runs become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def content_hash(text: Column) -> Column:
    """128 bits as a 16-byte value."""
    return F.unhex(F.md5(text))


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn=content_hash) -> DataFrame:
    """One row per distinct text: ``h, text, keep_id, group_size``."""
    keyed = columns_as(docs, id=id_col, text=text_col).select("id", normalized(F.col("text")).alias("text"))
    return (
        keyed.select("id", "text", hash_fn(F.col("text")).alias("h"))
        .groupBy("h", "text")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn=content_hash) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id, group_size, kept, text_sha256``."""
    classes = materialize(
        exact_classes(docs, id_col, text_col, hash_fn).select(
            "h", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"
        )
    )
    rows = columns_as(docs, id=id_col, text=text_col).select("id", normalized(F.col("text")).alias("text"))
    rows = rows.withColumn("h", hash_fn(F.col("text")))
    shared = classes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    if shared.isEmpty():
        found = rows.select("id", "h").join(classes, "h")
    else:
        shared = materialize(shared)
        apart = rows.join(shared, "h", "left_semi")
        texts = exact_classes(docs, id_col, text_col, hash_fn).join(shared, "h", "left_semi")
        texts = texts.withColumn("text_sha256", F.sha2("text", 256))
        plain = rows.select("id", "h").join(shared, "h", "left_anti").join(classes, "h")
        cols = ["id", "keep_id", "group_size", "text_sha256"]
        found = plain.select(cols).unionByName(apart.join(texts, ["h", "text"]).select(cols))
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        "text_sha256",
    )
