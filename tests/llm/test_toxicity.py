import math
import zlib

from netsift.llm import toxicity as tx
from netsift.llm.common import table


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def brute(text, weight):
    """Noisy-or over the sentences, written out."""
    parts = [w for _, _, w in tx.sentences(text)] or [[]]
    none = 1.0
    for words in parts:
        z = weight[-1] + sum(weight.get(f, 0.0) for f in {f for w in words for f in tx.word_features(w)})
        none *= 1 - 1 / (1 + math.exp(-z))
    return 1 - none


def test_held_out_accuracy_and_places(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = tx.fit_toxicity(docs, labels)
    got = {r.doc_id: r for r in tx.score_documents(docs, model).collect()}
    assert len(got) == docs.count()
    weight = dict(zip(model.feature, model.weight))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = [d for d in truth if is_held_out(d) and d in got]
    assert all(got[d].held_out == is_held_out(d) for d in got)
    hit = sum(got[d].predicted == 1 for d in held if truth[d])
    false = sum(got[d].predicted == 1 for d in held if not truth[d])
    # about one in fifteen labels of this table is noise
    assert hit >= 0.85 * sum(truth[d] for d in held) and false <= 0.01 * len(held), (hit, false, len(held))
    for d in held[:200]:
        assert abs(got[d].score - brute(texts[d], weight)) < 1e-9
    marked = [(texts[d][s.start : s.end]) for d in held if truth[d] for s in got[d].offending]
    assert len(marked) >= hit // 2 and all(len(tx.WORD.findall(m)) <= tx.WORDS for m in marked)


def test_labels_of_the_held_out_third_do_not_matter(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    from pyspark.sql import functions as F

    from netsift.llm.labelled import held_out

    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert tx.fit_toxicity(docs, labels).equals(tx.fit_toxicity(docs, turned))


def test_nulls_empty_long_and_no_labels(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (None, "bad words", "c"), (3, "x " * 300_000, None), (3, "x " * 300_000, None)],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame([(1, None), (None, 1), (7, 1)], "doc_id long, toxic int")
    got = tx.score_documents(docs, tx.fit_toxicity(docs, labels)).collect()
    assert [r.score for r in got] == [0.0] * 5 and [r.predicted for r in got] == [0] * 5
    model = __import__("pandas").DataFrame({"feature": [-1, tx.word_features("bad")[0]], "weight": [-3.0, 9.0]})
    got = tx.score_documents(docs, model).collect()
    assert got[0].score == got[1].score and got[2].predicted == 1 and got[2].offending[0].end == 9
    assert got[3].score == got[4].score
    assert tx.score_documents(docs.limit(0), model).collect() == []
