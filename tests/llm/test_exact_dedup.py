import hashlib
import re

from pyspark.sql import functions as F

from netsift.llm.exact_dedup import exact_dedup

ROWS = [
    (5, "a  b\n", "x"), (2, "a b ", "y"), (9, None, "z"), (7, "", None), (3, "c", "x"), (None, "c", "x"),
    (11, "word \t" * 40000, None), (10, "word " * 40000, None), (12, " ", None),
]
SCHEMA = "doc_id long, text string, keep_id string"


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    out = []
    for i, t, _ in rows:
        ids = [j for j, u, _ in rows if norm(u) == norm(t)]
        keep = min(j for j in ids if j is not None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_dedup_with_nulls_ties_and_clashing_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = exact_dedup(df)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(ROWS)


def test_colliding_hashes_are_told_apart(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    weak = exact_dedup(df, hash_fn=lambda t: F.length(t) % 2)
    assert sorted([tuple(r) for r in weak.collect()], key=str) == brute(ROWS)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
