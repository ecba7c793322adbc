import zlib

import numpy as np
import pandas as pd

from netsift.llm import quality as ql
from netsift.llm.common import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = {r.doc_id: r for r in ql.grade_documents(docs, ql.fit_quality(docs, labels)).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1 and d in got]
    assert all(got[d].held_out for d in held)
    good = [d for d in held if truth[d] == 1]
    bad = [d for d in held if truth[d] == 0]
    assert np.mean([got[d].kept for d in good]) >= 0.97
    assert np.mean([not got[d].kept for d in bad]) >= 0.85
    assert all(abs(r.expected_grade - r.tail_probability) < 1e-9 for r in got.values())  # two grades, 0 and 1


def test_ordered_grades():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 4, 600) * 2.0 + 1  # grades 1, 3, 5, 7
    texts = [" ".join(["good"] * int(g * 3) + ["bad"] * int(24 - g * 3) + [f"w{rng.integers(50)}" for _ in range(10)]) for g in y]
    model = pd.DataFrame(ql.train(texts, y))
    theta = model[model.kind == "threshold"].sort_values("at").value.to_numpy()
    assert (np.diff(theta) > 0).all()
    expected, tail = ql.Grader(model, tail=5.0)(texts)
    assert [expected[y == g].mean() for g in (1, 3, 5, 7)] == sorted(expected[y == g].mean() for g in (1, 3, 5, 7))
    assert np.abs(expected - y).mean() < 0.6
    assert ((tail >= 0.5) == (y >= 5)).mean() > 0.95


def test_scores_equal_the_plain_features(spark):
    model = pd.DataFrame(ql.train(["a b c", "X!! Y!! Z!!", "", "a a a a"] * 8, np.array([1, 0, 0, 1] * 8, float)))
    grader = ql.Grader(model)
    for t in ("", "a b", "X!! X!! q", "12 a12 -- ---", "ÄÖ ñ ß"):
        assert abs(grader.score(t) - sum(grader.weight.get(f, 0) * v for f, v in ql.features(t).items())) < 1e-9


def test_nulls_no_labels_long_and_empty(spark):
    docs = spark.createDataFrame([(1, None, 1), (None, "", 2), (2, "x " * 300_000, 3), (2, "x " * 300_000, 3)], "doc_id long, text string, kept int")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    got = ql.grade_documents(docs, ql.fit_quality(docs, none)).collect()
    assert [r.kept for r in got] == [True] * 4 and got[0].expected_grade is None
    model = pd.DataFrame(ql.train(["a", "b"] * 10, np.array([0.0, 1.0] * 10)))
    got = ql.grade_documents(docs, model).collect()
    assert got[0].tail_probability == got[1].tail_probability and got[2].tail_probability == got[3].tail_probability
    assert ql.grade_documents(docs.limit(0), model).collect() == []
