from netsift.llm.labelled import held_out, training_sample
from pyspark.sql import functions as F


def test_only_texts_that_do_not_fit_are_left_out(spark):
    docs = spark.createDataFrame([(i, "é" * (500 if i == 8 else 10)) for i in range(40)] + [(10, "again")], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("toxic")).distinct()
    learned = {r.doc_id for r in docs.filter(~held_out(F.col("doc_id"))).collect()}
    assert {8, 10} <= learned
    every = training_sample(docs, labels, "toxic", 100).collect()
    assert {r.id for r in every} == learned and len(every) == len(learned) + 1
    some = training_sample(docs, labels, "toxic", 100, max_bytes=900).collect()
    assert {r.id for r in some} == learned - {8} and all(r.y == 1.0 for r in some)
    few = training_sample(docs, labels, "toxic", 100, max_bytes=45).collect()
    assert 0 < sum(len(r.text.encode()) for r in few) <= 45
