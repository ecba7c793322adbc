"""Shared pieces: the tables, reliable materialization, document chunks, run reports."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.session import ensure_checkpoint_dir

#: Bytes of text in one chunk of documents: what one Python task holds at a time.
CHUNK_BYTES = 12 << 20

#: The white space of the contracts, as a regular-expression class.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint in the shared folder.

    The folder is the one ``spark.checkpoint.dir`` names, so lost executors cost
    nothing that is already written.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def columns_as(df: DataFrame, **named: str) -> DataFrame:
    """Only the named input columns, under fixed internal names, so extra columns never clash."""
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in named.items()])


def free_names(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with underscores behind it where ``taken`` has it already (upper and lower case alike)."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts (one narrow scan)."""
    return int(df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0])


def chunk_count(total_bytes: int, chunk_bytes: int = CHUNK_BYTES) -> int:
    """Chunks for a corpus: in proportion to its bytes, one at least."""
    return max(1, math.ceil(total_bytes / chunk_bytes))


def pseudo_random(column: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
