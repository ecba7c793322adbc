"""A bounded training sample of labelled documents, brought to one task that fits a model.

The sample is the one place where a bound is set: ``per_grade`` ids of each
grade, the first by a hash of the id, and at most ``max_bytes`` of text: in the order of another hash, an id
whose texts do not fit in what is left is passed over, whole. This is decided from the
lengths, before any text moves. Scoring is over all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BYTES = 64 << 20
MAX_GRADES = 16


def held_out(id_: Column) -> Column:
    """The third of the ids (by crc32 of their text) whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _fitting(sizes: pd.DataFrame, max_bytes: int) -> list:
    """The ids whose texts fit into ``max_bytes`` together, taken by the crc32 of the id."""
    at = [zlib.crc32(str(i).encode()) for i in sizes["id"]]
    taken, left = [], max_bytes
    for i, n in sizes.assign(at=at).sort_values(["at", "id"], kind="stable")[["id", "n"]].itertuples(index=False):
        if n <= left:
            taken.append(i)
            left -= n
    return taken


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_grade: int, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BYTES
) -> DataFrame:
    """``id, text, y`` of the sampled rows. Null ids and labels, and ids labelled twice with different grades, are no examples."""
    ids = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("double").alias("y"))
    ids = ids.filter("id is not null and y is not null").filter(~held_out(F.col("id")))
    grades = [r[0] for r in ids.select("y").distinct().orderBy("y").limit(MAX_GRADES + 1).collect()]
    if len(grades) > MAX_GRADES:
        raise ValueError(f"more than {MAX_GRADES} grades in {label}")
    picked = None
    for y in grades:
        some = ids.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_grade)
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        picked = ids.limit(0)
    picked = picked.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z")).filter("y = z").select("id", "y")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    picked = F.broadcast(picked)  # at most per_grade * MAX_GRADES rows
    sizes = texts.join(picked, "id").groupBy("id").agg(F.sum(F.octet_length("text")).alias("n")).toPandas()
    if int(sizes["n"].sum()) > max_bytes:
        fits = docs.sparkSession.createDataFrame([(i,) for i in _fitting(sizes, max_bytes)], ids.select("id").schema)
        picked = F.broadcast(picked.join(F.broadcast(fits), "id", "left_semi"))
    return texts.join(picked, "id").select("id", "text", "y")


def fit(sample: DataFrame, trainer: Callable[[list[str], np.ndarray], dict[str, list]], schema: str) -> pd.DataFrame:
    """Run ``trainer(texts, grades)`` in one task over the sample; its columns come to the driver."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        at = [zlib.crc32(str(i).encode()) for i in pdf["id"]]
        pdf = pdf.assign(at=at).sort_values(["at", "id"], kind="stable")
        return pd.DataFrame(trainer(pdf["text"].tolist(), pdf["y"].to_numpy()))

    return sample.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(run, schema).toPandas()


def telling(pairs: np.ndarray, positive: np.ndarray, size: int, z: float, min_docs: int) -> np.ndarray:
    """Features whose share of documents differs between the two classes by ``z`` standard errors.

    ``pairs`` are distinct ``feature << 32 | document``.
    """
    n, n1 = len(positive), int(positive.sum())
    feature, doc = pairs >> 32, pairs & 0xFFFFFFFF
    df = np.bincount(feature, minlength=size)
    with_ = np.bincount(feature[positive[doc]], minlength=size)
    share = df / max(n, 1)
    error = np.sqrt(np.maximum(share * (1 - share) * (1 / max(n1, 1) + 1 / max(n - n1, 1)), 1e-12))
    return (np.abs(with_ / max(n1, 1) - (df - with_) / max(n - n1, 1)) / error >= z) & (df >= min_docs)


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.99 * self.v + 0.01 * gradient**2
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)
