import hashlib
import zlib

import pytest

from netsift.llm.merkle import build, merkle_manifest
from tests.oracle_check import compare

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, t long, leaf string, h string, k int"


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(t):
    return None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def tree(digests):
    """Root and each leaf's list of (left siblings, right siblings)."""
    paths = [[] for _ in digests]
    at, nodes = list(range(len(digests))), digests
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            lo = i // 16 * 16
            paths[leaf].append(("".join(nodes[lo:i]), "".join(nodes[i + 1 : lo + 16])))
        nodes = [H("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0], H("".join(map(enc, r[:5]))), H("".join(map(enc, (*r[:4], lower(r[4])))))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs = []
    for s in order:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subs.append(tree([x[1] for x in by[s]]))
    if not subs:
        return []
    root, tops = tree([s[0] for s in subs])
    out = []
    for s, (sub, paths), top in zip(order, subs, tops):
        for (i, leaf, bent), path in zip(by[s], paths):
            fold = bent if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else leaf
            proof = ""
            for a, b in path + top:
                fold, proof = H(a + fold + b), proof + a + b
            out.append((i, leaf, sub, root, H(proof), fold, fold == root))
    return sorted(out, key=str)


def rows_of(sizes):
    out = []
    for s, n in sizes.items():
        out += [(len(out) * 7 + j * 3, s, "en" if j % 2 else None, j, f"Text {j} of {s}" * (j % 3), 1, "x", "y", 2) for j in range(n)]
    return out


ODD = [
    (1, None, None, None, None, 0, "", "", 0), (2, "", "en", 0, "", 0, "", "", 0), (None, "a", "en", 3, "ABC", 0, "", "", 0),
    (5, "a", "en", 3, "Äbc", 0, "", "", 0), (5, "a", "en", 3, "Äbc", 0, "", "", 0), (5, "a", "en", 4, "other", 0, "", "", 0),
    (-3, "é", "de", 1, "X" * 300_000, 0, "", "", 0), (7, "ｚ", "de", 1, "𝕏 Y", 0, "", "", 0), (None, None, "en", 3, "abc", 0, "", "", 0),
]


@pytest.mark.parametrize("rows", [
    rows_of({"a": 1}), rows_of({"a": 16}), rows_of({"a": 17}), rows_of({"a": 1, "b": 1}), ODD,
    rows_of({"a": 300, "b": 1, None: 33, "c": 16, **{f"s{i}": 1 + i % 3 for i in range(20)}}) + ODD,
], ids=["one", "run", "run-and-one", "two-lone", "odd", "mixed"])
def test_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = merkle_manifest(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_large_tree_over_partitions_and_batches(spark):
    rows = rows_of({"a": 5000, "b": 40, "c": 700})
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
        got = merkle_manifest(spark.createDataFrame(rows, SCHEMA))
        assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000000"


def test_nodes_are_linked_and_tables_may_be_empty(spark):
    runs, nodes = build(spark.createDataFrame(rows_of({"a": 300, "b": 20}), SCHEMA))
    rows = {r.node: r for r in nodes.collect()}
    assert len(rows) == 19 + 2 + 1 + 2 + 1 + 1
    for r in rows.values():
        assert r.parent is None or rows[r.parent].kids[64 * r.k : 64 * r.k + 64] == r.h
    assert sum(r.parent is None for r in rows.values()) == 1
    assert merkle_manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_oracle(spark):
    res = compare(spark, "/root/testdata/sf0.01", ["op11_merkle_manifest"], verbose=True)
    assert all(v[0] == "OK" for v in res.values()), res
