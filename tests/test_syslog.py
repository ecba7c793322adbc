import math

import pytest
from pyspark.sql import functions as F

from netsift.operators import syslog as sl


def test_golden_log_lines(spark):
    lines = ["Oct 11 22:14:15 host1 sshd[123]: Failed password for root", "Oct  1 22:14:15 h cron[9]: x\ny", "bad"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = sl.parse_syslog(df).collect()
    assert tuple(rows[0])[:5] == ("Oct 11 22:14:15", "host1", "sshd", "123", "Failed password for root")
    assert tuple(rows[1])[:5] == ("Oct  1 22:14:15", "h", "cron", "9", "x")
    assert tuple(rows[2])[:5] == ("", "", "", "", "") and rows[2].matched is False


def test_tfidf_example(spark):
    docs = ["Failed password for root", "Accepted password root the", ""]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(docs)], "k long, message string")
    model = sl.fit_tfidf(df, vocab_size=4, min_doc_freq=2, stop_words=["for", "the"])
    assert list(model.stages[2].vocabulary) == ["password", "root", "accepted", "failed"]
    idf = list(model.stages[3].getScalingVec().toArray())  # the IDF weights
    assert idf[2:] == [0.0, 0.0] and all(math.isclose(x, math.log(4 / 3)) for x in idf[:2])
    scored = sl.score(df, model).orderBy("k")
    dense = [r.d for r in scored.select(sl.dense_text().alias("d")).collect()]
    assert dense[0] == "0.28768207245178085, 0.28768207245178085, 0.0, 0.0"
    assert dense[2] == "0.0, 0.0, 0.0, 0.0"


def test_vocabulary_ties_by_term(spark):
    df = spark.createDataFrame([(0, "b a c"), (1, "c b a")], "k long, message string")
    t = sl.tokens(df, stop_words=[])
    assert sl.fit_vocabulary(t, 2) == ["a", "b"]


def test_line_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([(0, "Oct 11 22:14:15 h a[1]: x y")], "k long, value string")
    p = sl.parse_syslog(df, keep=("k",))
    model = sl.fit_tfidf(p, vocab_size=2)
    line = sl.to_syslog_line(sl.score(p, model)).first().value
    assert line.startswith("Oct 11 22:14:15,h,a,1,")
    nulled = sl.score(p, model).withColumn("pid", F.lit(None).cast("string"))
    assert sl.to_syslog_line(nulled).first().value is None


def test_default_stop_words():
    from netsift.stopwords import ENGLISH

    assert "the" in ENGLISH and len(ENGLISH) == len(set(ENGLISH)) > 100


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("Oct 1 00:00:00", "h", "a", "1", 'm, "q"'), ("", "", "", "", "")],
                               "timestamp string, hostname string, appname string, pid string, message string")
    sl.write_syslog_csv(df, str(tmp_path / "csv"))
    assert sorted(sl.read_syslog_csv(spark, str(tmp_path / "csv")).collect()) == sorted(df.collect())
    assert pytest  # keep import used


def test_one_pass_parse_equals_field_by_field(spark):
    from netsift import schemas

    good = "Oct 11 22:14:15 host app[12]: message"
    lines = [good, "Oct \n 11 22:14:15 h a[1]: m\nnext line", "\n" + good, "x" + good, good + "\r\nrest", "Oct 11 22:14:15 h\x01 a$1\\[7]: $2 \\n \n", "", None,
             "Oct 11 22:14:15 h a[1]: ", "Oct 11 22:14:15 h a[1]:", "Oct 11 22:14:15 h a[b][3]: [4]: z"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "k int, value string")
    want = df.select("k", *[F.regexp_extract("value", schemas.SYSLOG_PATTERN, i + 1).alias(n) for i, n in enumerate(schemas.SYSLOG_FIELDS)],
                     F.col("value").rlike(schemas.SYSLOG_PATTERN).alias("matched"))
    assert sl.parse_syslog(df, keep=("k",)).select(want.columns).orderBy("k").collect() == want.orderBy("k").collect()


def test_sketched_vocabulary_is_exact(spark):
    import random

    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    # Zipf-like lines, terms seen once, a hundred terms tied at the last place, lines without terms
    lines = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(400)], k=12)) + f" once{n}" for n in range(600)]
    lines += [" ".join(f"tie{i}" for i in range(100))] * 30 + ["", " "]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(lines)], "k long, message string")
    t = sl.tokens(df, stop_words=[]).select("filteredMessage").persist()
    distinct = sl.term_counts(t).count()
    for size, buckets in [(10, 4096), (50, 512), (120, 4096), (10, 1), (50, 3), (5000, 64)]:
        assert sl.vocabulary_statistics(t, size, buckets) == sl.vocabulary_statistics(t, size), (size, buckets)
    assert sl.frequent_term_counts(t, 10, 4096).count() < distinct / 5
    empty = t.limit(0)
    assert sl.vocabulary_statistics(empty, 5, 16) == sl.vocabulary_statistics(empty, 5)
    plan = sl.fit_tfidf(df, vocab_size=10, stop_words=[], sketch_buckets=512)
    assert list(plan.stages[2].vocabulary) == sl.fit_vocabulary(t, 10)


def test_sketch_rows_are_bounded_and_no_bucket_hides_a_term(spark):
    df = spark.createDataFrame([(0, " ".join(f"t{i}" for i in range(5000)) + " t7" * 9)], "k long, message string")
    t = sl.tokens(df, stop_words=[])
    sketch = sl.term_sketch(t, 64)
    assert sketch.count() <= sl.SKETCH_ROWS * 64
    assert [r.n for r in sketch.groupBy("row").agg(F.sum("n").alias("n")).collect()] == [5009] * sl.SKETCH_ROWS
    at = spark.createDataFrame([("t7",)], "term string").select(sl._bucket(0, 64)).first()[0]
    assert sketch.filter((F.col("row") == 0) & (F.col("bucket") == at)).first().n >= 10
