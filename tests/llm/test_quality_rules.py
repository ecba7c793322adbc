import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from netsift.llm.quality_rules import Rules, common_prefixes, maximal_repeats, measure, quality_rules, repeats_of, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, rules=Rules()):
    w = WORD.findall(text or "")
    n = len(w)
    places = {}
    for i in range(n - 2):
        places.setdefault(tuple(w[i : i + 3]), []).append(i)
    windows = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)}
    repeats = {}
    for l in range(rules.min_words, n):
        at = {}
        for i in range(n - l + 1):
            at.setdefault(tuple(w[i : i + l]), []).append(i)
        again = {k: p for k, p in at.items() if len(p) > 1}
        if not again:
            break
        for k, p in again.items():
            if len({w[i - 1] if i else None for i in p}) > 1 and len({w[i + l] if i + l < n else i for i in p}) > 1:
                repeats[k] = p
    spans = {i + j for k, p in repeats.items() for i in p for j in range(len(k))}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    longest = max(map(len, repeats), default=0)
    failed = n < rules.min_total or 100 * len(windows) > rules.max_window_percent * n
    bad = 100 * len(spans) > rules.max_percent * n or longest > rules.max_repeat
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(windows), failed, not failed and not bad, len(spans), longest, len(repeats))


def measured(texts, rules):
    found = measure(texts, rules)
    return [tuple(v[i].item() for v in found.values()) for i in range(len(texts))]


SMALL = Rules(min_total=5, max_window_percent=60, min_words=3, max_percent=40, max_repeat=6)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a a a b c d # \n é".split(" ")), max_size=40).map(" ".join), max_size=4))
def test_measure_against_brute_force(texts):
    assert measured(texts, SMALL) == [brute(t, SMALL) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(code):
    code = np.array(code, np.int64)
    sa, rounds = suffix_array(code)
    want = sorted(range(len(code)), key=lambda i: code[i:].tolist())
    assert sa.tolist() == want
    lcp = common_prefixes(sa, rounds).tolist()

    def same(a, b):
        k = 0
        while max(a, b) + k < len(code) and code[a + k] == code[b + k]:
            k += 1
        return k

    assert lcp == [0 if j == 0 else same(want[j - 1], want[j]) for j in range(len(code))]


ROWS = [
    (1, None), (2, ""), (None, "one two three " * 3), (4, "x"), (4, "a b c d e f g h i j k l m. " * 8), (5, "　wide space here " * 60),
    (6, " ".join(f"w{i}" for i in range(300))), (7, " ".join(f"w{i % 100}" for i in range(120))), (8, "\n".join(["same line"] * 40 + ["  ", "", "\r"])),
    (9, "x " * 30_000), (10, " ".join(f"v{i % 9000}" for i in range(20_000))), (11, "<b>#1|2</b> 5% & $3 *"),
    (12, "\n".join(f"item {i} costs {i * 3} coins" for i in range(80))),
]


def test_rows(spark):
    df = spark.createDataFrame([(i, t, True, 3) for i, t in ROWS], "doc_id long, text string, kept boolean, id int")
    got = quality_rules(df).collect()
    rules = Rules()
    small = [(i, t) for i, t in ROWS if i not in (9, 10)]
    assert sorted([tuple(r) for r in got if r.doc_id not in (9, 10)], key=str) == sorted([(i, *brute(t)) for i, t in small], key=str)
    by = {r.doc_id: r for r in got}
    assert by[9].longest_repeat == 29_999 and by[9].n_covered_words == 30_000 and by[9].base_failed
    assert by[10].longest_repeat == 11_000 and by[10].n_covered_words == 20_000 and not by[10].kept
    assert by[6].kept and not by[7].kept and rules.min_total == 50
    assert quality_rules(df.limit(0)).collect() == []


def test_a_passage_said_twice_is_named():
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = " ".join(word() for _ in range(30))
    text = " ".join([word() for _ in range(50)] + [passage, word(), passage] + [word() for _ in range(50)])
    found = repeats_of(text)
    assert found.values.tolist() == [[passage, 30, 2]]
    assert repeats_of("").empty


def test_whole_table(spark):
    import __spark_entry__ as entry

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in entry.queries()["op13_quality_rules"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        if len(r.text) < 4000:
            assert tuple(got[r.doc_id])[1:] == brute(r.text)


@pytest.mark.parametrize("size", [1, 7, 1 << 30])
def test_slabs_do_not_matter(spark, monkeypatch, size):
    import netsift.llm.quality_rules as q

    monkeypatch.setattr(q, "SLAB", size)
    texts = [t or "" for _, t in ROWS if len(t or "") < 5000]
    assert measured(texts, Rules()) == [m for t in texts for m in measured([t], Rules())]
