import math

import numpy as np
import pytest

from netsift.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, unit string"


def brute(rows, threshold=0.98):
    unit = [ed.unit_vector(v) if lab is not None else None for _, v, lab, *_ in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by = {}
    for i, u in enumerate(unit):
        if u is not None:
            by.setdefault((rows[i][2], len(u)), []).append(i)
    for at in by.values():
        x = np.stack([unit[i] for i in at])
        near = x @ x.T >= threshold
        np.fill_diagonal(near, False)
        for a, b in zip(*np.nonzero(near)):
            n[at[a]] += 1
            root[find(at[a])] = find(at[b])
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return [(r[0], n[i], low.get(find(i)), r[0] is not None and r[0] == low[find(i)]) for i, r in enumerate(rows)]


def planted(seed, n=900, lump=150, dim=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = rng.integers(0, 2, n)
    out, labels = list(x), list(lab)
    for i in range(60):
        for _ in range(rng.integers(1, 6)):
            out.append(x[i] + rng.normal(size=dim) * rng.choice([0.01, 0.03, 0.045]))
            labels.append(lab[i])
    for _ in range(lump):  # one lump with links and non-links
        out.append(x[70] + rng.normal(size=dim) * 0.025)
        labels.append(lab[70])
    for _ in range(40):
        out.append(x[71])
        labels.append(lab[71])
    order = rng.permutation(len(out))
    return [(int(i), out[i].astype(np.float32).tolist(), int(labels[i]), "u") for i in order]


@pytest.mark.parametrize("cell_rows", [1024, 100])
def test_against_brute_force(spark, cell_rows):
    rows = planted(cell_rows)
    got = {r.vec_id: tuple(r)[:4] for r in ed.embedding_groups(spark.createDataFrame(rows, SCHEMA), cell_rows=cell_rows).collect()}
    want = {r[0]: r for r in brute(rows)}
    total = sum(w[1] for w in want.values())
    assert all(got[i][1] <= w[1] for i, w in want.items())  # no link below the threshold
    assert sum(g[1] for g in got.values()) >= 0.97 * total
    assert sum(got[i][2:] == w[2:] for i, w in want.items()) >= 0.99 * len(want)


def hundreds(seed):
    return [(100 * i, *r) for i, *r in planted(seed)]


def test_clusters_of_low_recall_are_compared_exactly(spark, monkeypatch):
    monkeypatch.setattr(ed, "search", lambda x, edges, queries, threshold: np.zeros((len(queries), len(x)), bool))  # finds nothing at any overlap
    monkeypatch.setattr(ed, "BLOCK", 24 * 8 * 200)
    rows = hundreds(5)
    got = sorted(tuple(r) for r in ed.embedding_groups(spark.createDataFrame(rows, SCHEMA), cell_rows=100).collect())
    assert [g[:4] for g in got] == sorted(brute(rows))
    assert {g[4] for g in got} == {1.0}


def test_a_lump_does_not_hide_a_cluster_of_low_recall(spark, monkeypatch):
    rng = np.random.default_rng(3)
    v = rng.normal(size=24)
    lump = [(100 * i, (v + rng.normal(size=24) * 0.02).tolist(), 1, "u") for i in range(300)]
    pairs = [x for i in range(20) for x in 2 * [rng.normal(size=24)]]
    small = [(100 * (1000 + i), (x + rng.normal(size=24) * 0.01).tolist(), 2, "u") for i, x in enumerate(pairs)]
    real = ed.search
    # label 2 has few rows in its one shard, and nothing is found there
    monkeypatch.setattr(ed, "search", lambda x, edges, q, t: real(x, edges, q, t) if len(x) > 100 else np.zeros((len(q), len(x)), bool))
    got = {r.vec_id: tuple(r)[:4] for r in ed.embedding_groups(spark.createDataFrame(lump + small, SCHEMA)).collect()}
    want = {r[0]: r for r in brute(lump + small)}
    assert all(got[r[0]] == want[r[0]] for r in small)


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert sorted(tuple(r)[:4] for r in ed.embedding_groups(df).collect()) == sorted(brute(rows))


def test_nulls_zero_nonfinite_lengths_repeats_and_empty(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(9, v, 1, ""), (4, [2.0, 4.0, 6.0], 1, ""), (4, v, 1, None), (None, v, 1, ""), (5, v, 2, ""), (6, v, None, ""), (1, None, 1, ""), (2, [], 1, ""),
            (3, [0.0, 0.0, 0.0], 1, ""), (7, [1.0, None, 3.0], 1, ""), (8, [1.0, math.nan, 3.0], 1, ""), (10, [1.0, math.inf, 3.0], 1, ""), (11, [1.0, 2.0], 1, ""),
            (12, [1e-38, 2e-38, 3e-38], 1, ""), (13, [1e30, 2e30, 3.1e30], 1, "")]
    got = sorted([tuple(r)[:4] for r in ed.embedding_groups(spark.createDataFrame(rows, SCHEMA)).collect()], key=str)
    assert got == sorted(brute(rows), key=str)
    assert ed.embedding_groups(spark.createDataFrame([], SCHEMA)).collect() == []
