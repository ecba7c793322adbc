import hashlib

import pytest

from netsift.llm.line_dedup import drop_lines, line_digests
from tests.oracle_check import compare


def brute(rows):
    last = 2**63 - 1
    key = lambda x: x.encode().strip(b" \t\n\x0b\x0c\r").lower().decode()
    owner = {}
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            d = last if i is None else i
            owner[key(x)] = min(owner.get(key(x), d), d)
    out = []
    for i, t, *_ in rows:
        d = last if i is None else i
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or owner[key(x)] == d]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


ROWS = [
    (7, "Shared LINE number one\nshort\nown line of seven", "a"),
    (3, "  shared line NUMBER one\t\nshort\n\nÄÖÜäöüßñéè", "b"),
    (9, "shared line number one\nshared line number one\nÄÖÜäöüßñéè \nääÖÜäöüßñ", "c"),
    (12, None, "d"), (13, "", None), (None, "own line of seven\nnobody else has it", "e"),
    (15, "\n".join(["own line of seven", "x" * 100_000] * 50), "f"), (16, "x" * 100_000, "g"),
    (20, "said twice by one id\nsaid twice by one id", "h"), (20, "said twice by one id", "i"),
    (21, "shared line number one\r", "j"),
]


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (5, 3)])
def test_against_brute_force(spark, batches, fanout):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, d string")
    want = sorted([(i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in brute(ROWS)], key=str)
    got = line_digests(df, batches=batches, fanout=fanout)
    assert sorted([tuple(r) for r in got.collect()], key=str) == want


def test_texts_and_other_columns(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, d string")
    got = drop_lines(df)
    assert got.columns == ["doc_id", "d", "text", "n_lines", "n_dropped"]
    assert sorted((str(r.doc_id), r.d or "", r.text or "") for r in got.collect()) == sorted(
        (str(i), x or "", t) for (i, _, _, t), (_, _, x) in zip(brute(ROWS), ROWS)
    )
    assert line_digests(df.limit(0)).collect() == []


def test_oracle(spark):
    res = compare(spark, "/root/testdata/sf0.01", ["op7_line_dedup", "op2_exact_dedup"], verbose=False)
    assert all(v[0] == "OK" for v in res.values()), res


def test_null_ids_keep_their_own_keys(spark):
    rows = [(1, "a line of the first one"), (None, "a line of the first one\nand one of its own, first"), (None, "a line of the first one"),
            (None, "no line in common with it"), (None, "a line of the first one")]
    df = spark.createDataFrame([(*r, "n", 3) for r in rows], "doc_id long, text string, N_LINES string, n_dropped int")
    got = drop_lines(df)
    assert got.columns == ["doc_id", "N_LINES", "n_dropped", "text", "n_lines_", "n_dropped_"]
    assert sorted(r.text for r in got.collect()) == ["", "", "a line of the first one", "and one of its own, first", "no line in common with it"]


def test_runs_leave_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    drop_lines(spark.createDataFrame(ROWS, "doc_id long, text string, d string")).collect()
    assert {t.name for t in spark.catalog.listTables()} <= before
