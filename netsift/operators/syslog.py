"""Log lines: parse, tokenize, drop stop words, fit and apply TF-IDF, format.

Parsing is one pass of the pattern over a line; scoring is a Spark ML
``PipelineModel`` (RegexTokenizer -> StopWordsRemover -> CountVectorizerModel
-> ElementwiseProduct by the IDF weights), a chain of narrow projections that
runs unchanged on a stream.

Fitting is one distributed pass: term and line counts are one partial
(map-side) aggregation, so a term in every line costs one row per task; only
the ``vocab_size`` most frequent terms reach the driver. Ties in frequency are
broken by the term text, so the vocabulary is deterministic.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift import schemas
from netsift.stopwords import ENGLISH


def read_stop_words(spark: SparkSession, path: str, max_words: int = 100_000) -> list[str]:
    """A stop-word file (one word per line), read through Spark from any filesystem.

    A stop-word list is configuration; its size is checked before it is
    brought to the driver.
    """
    words = spark.read.text(path).select(F.trim("value").alias("w")).filter(F.col("w") != "")
    n = words.count()
    if n > max_words:
        raise ValueError(f"stop-word file has {n} words, above max_words={max_words}")
    return [r.w for r in words.collect()]


def parse_syslog(df: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Text (or binary payload) -> timestamp, hostname, appname, pid, message.

    A line that does not match gives five empty strings and is kept, as a
    regex extraction does; ``matched`` tells them apart.
    """
    keep = [c for c in keep if c in df.columns]
    # One pass of the pattern over a line, whichever fields are read: the match is
    # rewritten as newline-separated parts, the timestamp last. No other field can
    # hold a newline, and no line that matches begins with one.
    stage = df.select(*keep, F.col(column).cast("string").alias("_line"))
    rewritten = F.regexp_replace("_line", schemas.SYSLOG_PATTERN + r"(?s:.*)$", "\n$2\n$3\n$4\n$5\n$1")
    parts = F.when(~F.startswith("_line", F.lit("\n")) & F.startswith(rewritten, F.lit("\n")), F.split(rewritten, "\n", 6))
    stage = stage.select(*keep, "_line", F.explode(F.array(parts)).alias("_parts"))
    matched = F.col("_parts").isNotNull()
    place = dict(zip(("hostname", "appname", "pid", "message", "timestamp"), range(1, 6)))
    text = {n: F.when(matched, F.get("_parts", F.lit(place[n]))).when(F.col("_line").isNotNull(), "") for n in schemas.SYSLOG_FIELDS}
    return stage.select(*keep, *[text[n].alias(n) for n in schemas.SYSLOG_FIELDS],
                        F.when(F.col("_line").isNotNull(), matched).alias("matched"))


def read_syslog_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less CSV of the five syslog fields.

    Fields of a parsed line are never NULL (an unmatched line gives empty
    text), so an empty cell is read as empty text.
    """
    raw = spark.read.schema(schemas.SYSLOG).option("header", "false").csv(path)
    return raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in schemas.SYSLOG_FIELDS])


def write_syslog_csv(df: DataFrame, path: str) -> None:
    """Header-less CSV of the five fields, every field quoted."""
    df.select(*schemas.SYSLOG_FIELDS).write.mode("overwrite").option("header", "false").option("quoteAll", "true").csv(path)


def tokenizer() -> RegexTokenizer:
    """Lower-case and split the message on whitespace."""
    return RegexTokenizer(inputCol="message", outputCol="tokenizedMessage", toLowercase=True)


def stop_words_remover(stop_words: Sequence[str] | None = None) -> StopWordsRemover:
    """Drop stop words, case-insensitively, keeping duplicates."""
    words = list(stop_words) if stop_words is not None else list(ENGLISH)
    return StopWordsRemover(
        inputCol="tokenizedMessage", outputCol="filteredMessage", caseSensitive=False, stopWords=words
    )


def tokens(df: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    """Add ``tokenizedMessage`` and ``filteredMessage``."""
    return stop_words_remover(stop_words).transform(tokenizer().transform(df))


def vocabulary_counts(filtered: DataFrame, vocab_size: int = schemas.VOCAB_SIZE) -> DataFrame:
    """The ``vocab_size`` most frequent terms: ``term, tf, rank``.

    ``tf`` is the corpus count; ``rank`` orders by ``tf`` descending, then
    term, from 1. The rank window runs over the ``vocab_size`` rows left
    after the top-k, never over the corpus.
    """
    from pyspark.sql import Window

    counts = filtered.select(F.explode("filteredMessage").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("tf")
    )
    top = counts.orderBy(F.col("tf").desc(), F.col("term")).limit(vocab_size)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("tf").desc(), F.col("term"))))


def _entries(filtered: DataFrame) -> DataFrame:
    """``term, tf, df`` entries of every line, to be summed by term; the NULL term counts the lines."""
    entries = F.expr(
        "concat(transform(filteredMessage, t -> named_struct('term', t, 'tf', 1L, 'df', 0L)),"
        " transform(array_distinct(filteredMessage), t -> named_struct('term', t, 'tf', 0L, 'df', 1L)),"
        " array(named_struct('term', cast(null as string), 'tf', 0L, 'df', 1L)))"
    )
    return filtered.select(F.explode(entries).alias("e")).select("e.*")


def _summed(entries: DataFrame) -> DataFrame:
    return entries.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def term_counts(filtered: DataFrame) -> DataFrame:
    """``term, tf, df``: corpus count and number of lines of every term; the NULL term counts the lines.

    One pass and one shuffle for both counts; map-side combine leaves one row per task and term.
    """
    return _summed(_entries(filtered))


#: Rows of the sketch of term counts, each with a hash of its own.
SKETCH_ROWS = 2


def _bucket(row: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), "term"), F.lit(buckets)).cast("int")


def term_sketch(filtered: DataFrame, buckets: int) -> DataFrame:
    """``row, bucket, n``: how many tokens fall into each bucket of each row of hashes.

    The sums of two corpora are the sums of their sketches, and a task hands on ``SKETCH_ROWS * buckets`` rows at most,
    however many distinct terms it has. No bucket counts less than any of its terms.
    """
    terms = filtered.select(F.explode("filteredMessage").alias("term")).filter(F.col("term").isNotNull())
    cells = F.explode(F.array(*[F.struct(F.lit(r).alias("row"), _bucket(r, buckets).alias("bucket")) for r in range(SKETCH_ROWS)]))
    return terms.select(cells.alias("c")).groupBy("c.row", "c.bucket").agg(F.count(F.lit(1)).alias("n"))


def frequent_term_counts(filtered: DataFrame, vocab_size: int, buckets: int) -> DataFrame:
    """``term_counts`` of some terms only, among them every term of the ``vocab_size`` most frequent ones (ties included).

    For corpora whose distinct terms are too many to shuffle. Terms are counted exactly where all their buckets
    reach a threshold; the least count of the ``vocab_size`` best of them is one that the true last place
    reaches too. No term with that count is outside if the threshold was not above it; else
    the terms are counted once more, with that count as the threshold. Where the buckets tell nothing apart, or the corpus has
    too few terms, that counts every term. The lines are read two or three times, and beside the
    sketch only counted terms are shuffled.
    """
    from netsift.operators.anonymize import materialize

    sketch = materialize(term_sketch(filtered, buckets))
    nth = sketch.filter("row = 0").orderBy(F.col("n").desc()).limit(4 * vocab_size).agg(F.min("n")).first()[0]

    def counted(least: int) -> DataFrame:
        rows = _entries(filtered)
        for r in range(SKETCH_ROWS):
            # at most `buckets` numbers; the NULL term stands for the lines
            heavy = sketch.filter((F.col("row") == r) & (F.col("n") >= least)).select("bucket").unionByName(
                filtered.sparkSession.range(1).select(F.lit(-1).alias("bucket")))
            of_term = F.when(F.col("term").isNull(), -1).otherwise(_bucket(r, buckets)).alias("bucket")
            rows = rows.select("*", of_term).join(F.broadcast(heavy), "bucket", "left_semi").drop("bucket")
        return materialize(_summed(rows))

    found = counted(nth or 0)
    best = found.filter("term is not null").orderBy(F.col("tf").desc()).limit(vocab_size)
    last, n = best.agg(F.min("tf"), F.count(F.lit(1))).first()
    if n == vocab_size and last >= nth:
        return found
    return counted(last if n == vocab_size else 0)


def fit_vocabulary(filtered: DataFrame, vocab_size: int = schemas.VOCAB_SIZE) -> list[str]:
    """Terms by corpus frequency, ties by term text."""
    return vocabulary_statistics(filtered, vocab_size)[0]


def vocabulary_statistics(
    filtered: DataFrame, vocab_size: int = schemas.VOCAB_SIZE, sketch_buckets: int | None = None
) -> tuple[list[str], list[int], int]:
    """Terms by corpus frequency, ties by term text, with their line counts, and the number of lines.

    At most ``vocab_size`` + 1 rows reach the driver. With ``sketch_buckets`` the terms to count are first
    found by a sketch of so many buckets a row (``frequent_term_counts``); the result is the same.
    """
    counts = frequent_term_counts(filtered, vocab_size, sketch_buckets) if sketch_buckets else term_counts(filtered)
    first = F.col("term").isNull().desc()
    rows = counts.orderBy(first, F.col("tf").desc(), F.col("term")).limit(vocab_size + 1).collect()
    lines = rows[0].df if rows else 0
    return [r.term for r in rows[1:]], [r.df for r in rows[1:]], lines


def idf_weights(df: Sequence[int], lines: int, min_doc_freq: int) -> list[float]:
    """``ln((lines + 1) / (df + 1))`` per term, 0 below the minimum line count (T5)."""
    return [math.log((lines + 1) / (n + 1)) if n >= min_doc_freq else 0.0 for n in df]


def fit_tfidf(
    df: DataFrame,
    *,
    vocab_size: int = schemas.VOCAB_SIZE,
    min_doc_freq: int = schemas.MIN_DOC_FREQ,
    stop_words: Sequence[str] | None = None,
    sketch_buckets: int | None = None,
) -> PipelineModel:
    """Fit tokenizer -> stop words -> term counts -> IDF weights on parsed lines (T3, T5, T9), in one pass over them.

    ``sketch_buckets`` (16,384 is a good number) is for corpora of very many distinct terms: more passes, a bounded shuffle, the same model.
    """
    tok, rem = tokenizer(), stop_words_remover(stop_words)
    filtered = rem.transform(tok.transform(df.select("message"))).select("filteredMessage")
    vocab, counts, lines = vocabulary_statistics(filtered, vocab_size, sketch_buckets)
    tf = CountVectorizerModel.from_vocabulary(vocab, inputCol="filteredMessage", outputCol="tfFeatures")
    weights = Vectors.dense(idf_weights(counts, lines, min_doc_freq))
    idf = ElementwiseProduct(scalingVec=weights, inputCol="tfFeatures", outputCol="tfidfFeatures")
    return PipelineModel(stages=[tok, rem, tf, idf])


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add tokens, ``tfFeatures`` and ``tfidfFeatures`` (T4, T6, T10); batch or stream."""
    return model.transform(df)


def dense_text(vector: str = "tfidfFeatures") -> Column:
    """Dense vector as text: values joined by ``", "``."""
    return F.array_join(F.transform(vector_to_array(vector), lambda x: x.cast("string")), ", ")


def dense_array(vector: str = "tfidfFeatures") -> Column:
    """Dense vector as ``array<double>``."""
    return vector_to_array(vector)


def to_syslog_line(df: DataFrame, vector: str = "tfidfFeatures", keep: Sequence[str] = ()) -> DataFrame:
    """``timestamp,hostname,appname,pid,<dense values>`` in ``value``.

    A NULL part makes the whole line NULL, as ``concat`` does.
    """
    line = F.concat("timestamp", F.lit(","), "hostname", F.lit(","), "appname", F.lit(","), "pid", F.lit(","),
                    dense_text(vector))
    return df.select(*keep, line.alias("value"))


def sparse_entries(df: DataFrame, vector: str, keep: Sequence[str] = ("k",)) -> DataFrame:
    """Non-zero vector entries in long form: ``keep..., pos, x``; zeros are left out before rows are made."""
    numbered = F.transform(vector_to_array(vector), lambda x, i: F.struct(i.alias("pos"), x.alias("x")))
    return df.select(*keep, F.inline(F.filter(numbered, lambda e: e["x"] != 0)))


def stop_words_sql(stop_words: Sequence[str] | None = None) -> str:
    """The stop-word list as a SQL list literal (for the oracle)."""
    words = list(stop_words) if stop_words is not None else list(ENGLISH)
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
