import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import netsift.llm.collocations as co
from netsift.llm.collocations import blocks, collocations, graph, paths, runs, words_of
from tests.oracle_check import compare

CUT = re.compile(r"[.,;:!?\x0A-\x0D]")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    f, total = {}, Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in CUT.split((text or "").translate(LOWER)):
            w = tuple(x for x in re.split(r"[\x20\x09]+", piece) if x)
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[w[i : i + k]] += 1
    return f, total


def brute(rows, min_count, top, covered=80):
    out = []
    by, total = counts(rows)
    for lang, f in by.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = {p[i:j] for p, c in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * c >= covered * f[p[i:j]]}
        made = []
        for p, a in cand.items():
            if p not in gone:
                score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                made.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(made)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "B", "c", "Ä", "d", "e-e", "f", "rare%d"]
    passage = "the Old\tman   went to the big sea and came back again"
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            some = [rng.choice(words) for _ in range(rng.randrange(9))]
            parts.append(rng.choice([passage, " ".join(w % rng.randrange(500) if "%" in w else w for w in some)]))
        rows.append((rng.choice([i, None, 3]), rng.choice(["en", "de", None, "und", ""]), rng.choice([" ", ". ", ",", "\n", "\r\n", "!? "]).join(parts)))
    return rows + [(1, "en", None), (2, "en", ""), (2, "en", "a a a a a a a a"), (4, "de", "x " * 3000), (5, None, ".;:"), (6, "one", "single words. only")]


FRAME = "doc_id long, lang string, text string, word string, n long, c int, id int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "w", 1, 2, 3) for r in rows], FRAME)


@pytest.mark.parametrize("seed,kw", [
    (1, {}), (2, {"block": 40, "parts": 5}), (3, {"dictionary": 4, "parts": 3}), (4, {"top": 5, "min_count": 3, "block": 200}), (5, {"dictionary": 0}),
])
def test_against_brute_force(spark, seed, kw):
    rows = random_rows(seed)
    kw = {"min_count": 4, "top": 50, **kw}
    got = collocations(frame(spark, rows).repartition(3), **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, kw["min_count"], kw["top"])
    assert len(want) > 10 and sorted(tuple(r) for r in got.collect()) == want


def test_salted_pairs_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(co, "ROWS", 7)
    rng = random.Random(9)
    rows = [(i, "en", " ".join(f"of the w{rng.randrange(4)} w{rng.randrange(9)}" for _ in range(30))) for i in range(40)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
        got = collocations(frame(spark, rows), min_count=10, block=300, parts=4)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, 2000)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_flows_give_all_shorter_counts(spark):
    rows = random_rows(7)
    g = graph(frame(spark, rows), min_count=4)
    f, _ = counts(rows)
    name = {r.id: (r.lang, r.word) for r in g["words"].collect()}
    for size, table in ((1, "single"), (2, "pair"), (3, "node"), (4, "edge")):
        got = {}
        for r in g[table].collect():
            ids = [r[w] for w in co.WORDS[:size]]
            got[name[ids[0]][0], tuple(name[i][1] for i in ids)] = r.c
        assert got == {(lang, p): c for lang in f for p, c in f[lang].items() if len(p) == size and c >= 4}


def test_unary_paths_are_compacted(spark):
    passage = " ".join(f"p{i}" for i in range(150))
    rows = [(i, "en", passage) for i in range(6)] + [(9, "en", "p0 p1 p2 p3 q"), (10, "en", "p70 p71 p72")]
    g = graph(frame(spark, rows), min_count=5)
    found = paths(g).collect()
    lengths = {r.path: 0 for r in found}
    for r in found:
        lengths[r.path] += len(r.phrase.split(" "))
    # what begins like the passage, and what ends inside it, part it into three paths
    assert sum(r.place == 0 for r in g["place"].collect()) == len(lengths) == 3 and sum(lengths.values()) == 147 + 3 * len(found)
    # node p1 p2 p3 has flow 7, p70 p71 p72 has 7, all others 6
    first = next(r for r in found if r.phrase == "p0 p1 p2 p3")
    assert first.c == 7
    got = collocations(frame(spark, rows), min_count=5)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 2000)


def test_empty_tables(spark):
    assert collocations(frame(spark, []).limit(0)).collect() == []
    assert collocations(frame(spark, [(1, "en", "few words"), (2, None, None)])).collect() == []


def test_helpers():
    text = "One two.three\tfour  five!\n".encode() * 50
    assert b"".join(blocks([text], 30)) == text.lower() and all(b.endswith((b".", b"!", b"\n")) for b in blocks([text], 30))
    words, piece = words_of("Ab  é\tc.d".encode().lower())
    assert [w.decode() for w in words.to_pylist()] == ["ab", "é", "c", "d"] and piece.tolist() == [0, 0, 0, 1]
    grams, count = next(runs(np.array([5, 6, 0, 5, 6, 7, 8, 9]), np.zeros(8, np.int32)))
    assert grams.T.tolist() == [[5, 6, 0, 0], [5, 6, 7, 8], [6, 0, 0, 0], [6, 7, 8, 9], [7, 8, 9, 0], [8, 9, 0, 0], [9, 0, 0, 0]] and count.sum() == 7
    assert list(runs(np.zeros(3, np.int64), np.zeros(3, np.int32))) == [] and isinstance(words, pa.Array)


def test_oracle(spark):
    res = compare(spark, "/root/testdata/sf0.01", ["op12_collocations"], verbose=True)
    assert all(v[0] == "OK" for v in res.values()), res
