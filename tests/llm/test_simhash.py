import random
import re

import numpy as np
import pytest
import xxhash

from netsift.llm import simhash_dedup as sh
from netsift.llm.common import table
from netsift.llm.components import components


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(ids, fps, t=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    fps = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= t):
            root[find(i)] = find(i + 1 + int(j))
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def test_table_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.simhash_groups(docs).collect()}
    rows = docs.collect()
    fps = [brute_fp(r.text) for r in rows]
    want = brute_groups([r.doc_id for r in rows], fps)
    assert got == {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, fps, want)}


@pytest.mark.parametrize("tile_rows", [None, 40])
def test_planted_fingerprints(spark, tile_rows):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:60]:
        for _ in range(4):
            for b in rng.sample(range(64), rng.choice([1, 3, 4, 5, 6])):
                f ^= 1 << b
            fps.add(f)
    fps |= {sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(100)} | {0, 2**64 - 1}
    fps = sorted(fps)
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r.node: r.root for r in components(sh.links(df, tile_rows=tile_rows), "a", "b").collect()}
    want = brute_groups(signed, fps)
    assert [roots.get(f, f) for f in signed] == want


def test_covering():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**64, 500, dtype=np.uint64)
    homes, reach = [set() for _ in x], [set() for _ in x]
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, 4, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    for at, a, away in sh.anchors(x):
        for i, k in zip(at[away == 0], a[away == 0]):
            homes[i].add(int(k))
    for at, a, _ in sh.anchors(y):
        for i, k in zip(at, a):
            reach[i].add(int(k))
    assert all(h & r for h, r in zip(homes, reach))


def test_nulls_empty_and_long(spark):
    rows = [(4, None, "x"), (3, "", "y"), (None, " \n", "z"), (9, "one Two", None), (8, "ONE two", "x"),
            (12, "w " * 200000, "x"), (11, "w " * 200000, "x"), (11, "w " * 200000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted([tuple(r) for r in sh.simhash_groups(df).collect()], key=str)
    ids, fps = [r[0] for r in rows], [brute_fp(r[1]) for r in rows]
    want = sorted([(i, f"{f:016x}", c) for i, f, c in zip(ids, fps, brute_groups(ids, fps))], key=str)
    assert got == want
    assert sh.simhash_groups(df.limit(0)).collect() == []


def test_components_of_a_path(spark):
    rng = random.Random(4)
    ids = list(range(200))
    rng.shuffle(ids)
    df = spark.createDataFrame([(ids[i], ids[i + 1]) for i in range(199)] + [(5, 5), (None, 3), (500, 501)], "x long, y long")
    got = {r.node: r.root for r in components(df, "x", "y").collect()}
    assert got == {**{i: 0 for i in range(1, 200)}, 501: 500}
