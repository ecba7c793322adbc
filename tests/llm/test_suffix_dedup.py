import hashlib
import random

import numpy as np
import pytest

from netsift.llm import suffix_dedup as sd
from netsift.llm.common import table

LAST = 2**63 - 1


def brute(rows, width=50):
    texts = [(LAST if i is None else i, (t or "").encode()) for i, t, *_ in rows]
    first = {}
    for d, t in texts:
        for s in range(len(t) - width + 1):
            w = t[s : s + width]
            first[w] = min(first.get(w, LAST), d)
    out = []
    for (i, *_), (d, t) in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - width + 1):
            if first[t[s : s + width]] < d:
                gone[s : s + width] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(rng, n=60):
    word = lambda: "".join(rng.choice("abcdeé\0") for _ in range(rng.randint(1, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(rng.randint(8, 40)) for _ in range(6)]
    rows = []
    for i in rng.sample(range(1000), n):
        parts = [text(rng.randint(0, 60)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        rows.append((i, " ".join(parts), "x"))
    for i in range(8):  # near copies, copies, periodic texts
        t = list(rows[i][1])
        t[len(t) // 2] = "Z"
        rows.append((2000 + i, "".join(t), None))
    rows += [(3000 + i, rows[i][1], None) for i in range(5)]
    rows += [(4000, "ab" * 300, None), (4001, "ba" * 200, None), (4002, "a" * 49, None), (4003, "a" * 120, None), (4004, "a" * 50, "y")]
    rows += [(4005, None, "z"), (4006, "", "z"), (None, rows[0][1], "z"), (7, rows[3][1], "q"), (7, rows[3][1], "q"), (4007, "\0" * 200, ""), (4008, "\0" * 60, "")]
    return rows


SCHEMA = "doc_id long, text string, o string"


@pytest.mark.parametrize("shard_bytes,merge", [(6 << 20, 256), (3000, 256), (2000, 3)])
def test_against_brute_force(spark, shard_bytes, merge):
    rows = corpus(random.Random(shard_bytes))
    got = sd.repeat_digests(spark.createDataFrame(rows, SCHEMA), shard_bytes=shard_bytes, merge=merge).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_other_widths(spark):
    rows = corpus(random.Random(9), 20)
    for width in (8, 20, 90):
        got = sd.repeat_digests(spark.createDataFrame(rows, SCHEMA), width=width, shard_bytes=4000).collect()
        assert sorted([tuple(r) for r in got], key=str) == brute(rows, width)


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = sd.repeat_digests(docs, shard_bytes=100_000).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute([tuple(r) for r in docs.collect()])


def test_texts_other_columns_and_empty(spark):
    df = spark.createDataFrame([(2, "é" * 60, "b"), (1, "x" + "é" * 40, "a"), (3, "y", None)], SCHEMA)
    got = {r.doc_id: (r.text, r.o, r.n_removed) for r in sd.cut_repeats(df).collect()}
    assert got == {1: ("x" + "é" * 40, "a", 0), 2: ("", "b", 120), 3: ("y", None, 0)}
    assert sd.repeat_digests(df.limit(0)).collect() == []


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for text in (b"banana", b"\0\0\0\0\0\0\0\0\0\0", b"ab" * 40, bytes(rng.choice(b"ab\0") for _ in range(500)), b"x", b""):
        buf = sd.padded(text)
        sa = sd.suffix_order(buf, len(text))
        assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        lcp = sd.common_prefixes(buf, sa, 30)
        for k in range(1, len(sa)):
            a, b = text[sa[k - 1] :], text[sa[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[k] == min(n, 30)


def test_colliding_keys_are_told_apart():
    flat = np.frombuffer(b"aaaaaaaabbbbbbbbaaaaaaaacccccccc" + bytes(8), np.uint8)
    cls = sd.same_strings(np.zeros(4, np.uint64), flat, np.arange(4) * 8, 8)
    assert cls[0] == cls[2] and len(set(cls.tolist())) == 3


def test_names_that_documents_have_already(spark):
    df = spark.createDataFrame([(1, "a" * 60, 5, "k"), (2, "a" * 60, 6, "l")], "doc_id long, text string, n_bytes long, kept string")
    got = sd.cut_repeats(df)
    assert got.columns == ["doc_id", "n_bytes", "kept", "text", "n_bytes_", "n_removed", "n_spans"]
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == [(1, 5, "k", "a" * 60, 60, 0, 0), (2, 6, "l", "", 60, 60, 1)]


def test_text_longer_than_a_shard(spark):
    import random

    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(200_000))
    rows = [(1, "x" + long[70_000:70_080] + "y"), (2, long), (3, long[150_000:] + "z"), (4, "q")]
    got = {r.doc_id: r for r in sd.repeat_digests(spark.createDataFrame(rows, "doc_id long, text string"), shard_bytes=4096).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[2].n_spans, got[3].n_removed, got[4].n_removed) == (0, 80, 1, 50_000, 0)


def test_a_merge_makes_one_table_of_all_shards(spark, monkeypatch):
    """As many rows as shards meet in a bucket; a table for each of them would make the work quadratic in the shards."""
    made, table_of = [], sd.pa.table
    a = sd.Anchoring(50)

    class Grouped:
        def withColumn(self, *args):
            return self

        def groupBy(self, *args):
            return self

        def applyInArrow(self, run, schema):
            made.append(run)
            return self

        def filter(self, *args):
            return self

        select = filter

    sd._across_shards(Grouped(), a, 40, 256)
    rec = np.tile(np.arange(a.span, dtype=np.uint8), (1, 1))
    mask = np.array([1], "<u8")
    blobs = [sd.pack_arrays(rec, np.array([d], "<i8"), mask, np.array([100 + d], "<i8")) for d in range(40)]
    rows = sd.pa.table({"bucket": sd.pa.array([3] * 40, sd.pa.int32()), "shard": sd.pa.array(range(40), sd.pa.int64()),
                        "strings": sd.pa.array(blobs, sd.pa.binary()), "gone": sd.pa.nulls(40, sd.pa.binary())})
    calls = []
    monkeypatch.setattr(sd.pa, "table", lambda *x: calls.append(1) or table_of(*x))
    out = made[0](rows)
    assert len(calls) == 1
    gone = {s: sd.unpack_arrays(g, "<i8")[0].tolist() for s, g in zip(out["shard"].to_pylist(), out["gone"].to_pylist()) if g}
    assert gone == {d: [100 + d] for d in range(1, 40)}  # all but the smallest document's
