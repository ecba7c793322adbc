"""Registered log queries: parse, tokens, stop words, vocabulary, TF, IDF, TF-IDF, lines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from netsift import fixtures, schemas
from netsift.operators import syslog as sl
from netsift.plans.common import with_cte
from netsift.plans.registry import register
from netsift.session import scratch_path

_SW = sl.stop_words_sql()
# the log-line pattern in RE2 form; `.` of the JVM pattern stops at any line terminator
_RE = r"^(\w{3}\s+\d+\s\d{2}:\d{2}:\d{2})\s(\S+)\s(\S+)\[(\d+)\]:\s([^\n\r\x{85}\x{2028}\x{2029}]*)"

SYSLOG_CTE = f"""
docs AS (
  SELECT doc_id AS k,
    concat('Oct ', CAST(1 + doc_id % 28 AS VARCHAR), ' 22:14:', lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0'),
           ' host', CAST(doc_id % 7 AS VARCHAR), ' app', CAST(doc_id % 5 AS VARCHAR),
           CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat('[', CAST(doc_id AS VARCHAR), ']') END, ': ',
           regexp_replace(text, '[\\s]+', ' ', 'g')) AS value
  FROM documents
),
parsed AS (
  SELECT k, regexp_extract(value, '{_RE}', 1) AS timestamp, regexp_extract(value, '{_RE}', 2) AS hostname,
         regexp_extract(value, '{_RE}', 3) AS appname, regexp_extract(value, '{_RE}', 4) AS pid,
         regexp_extract(value, '{_RE}', 5) AS message
  FROM docs
),
toks AS (
  SELECT k, list_filter(regexp_split_to_array(lower(message), '\\s+'), lambda x: x <> '') AS tokens FROM parsed
),
filt AS (
  SELECT k, list_filter(tokens, lambda x: NOT list_contains({_SW}, x)) AS filtered FROM toks
),
counts AS (SELECT term, count(*) AS tf FROM (SELECT unnest(filtered) AS term FROM filt) GROUP BY term),
vocab AS (
  SELECT term, tf, CAST(row_number() OVER (ORDER BY tf DESC, term) AS INTEGER) AS rank
  FROM counts QUALIFY row_number() OVER (ORDER BY tf DESC, term) <= {schemas.VOCAB_SIZE}
),
tf AS (
  SELECT f.k, v.rank - 1 AS pos, CAST(count(*) AS DOUBLE) AS x
  FROM (SELECT k, unnest(filtered) AS term FROM filt) f JOIN vocab v USING (term)
  GROUP BY f.k, v.rank
),
idf AS (
  SELECT v.rank - 1 AS pos,
    CASE WHEN count(DISTINCT t.k) >= {schemas.MIN_DOC_FREQ}
         THEN ln(((SELECT count(*) FROM parsed) + 1.0) / (count(DISTINCT t.k) + 1.0)) ELSE 0.0 END AS idf
  FROM vocab v LEFT JOIN tf t ON t.pos = v.rank - 1
  GROUP BY v.rank
)"""
SYSLOG = with_cte(SYSLOG_CTE)


def parsed_logs(spark, sf_dir):
    env = fixtures.syslog_envelope(spark, sf_dir)
    return sl.parse_syslog(env, keep=("offset",)).withColumnRenamed("offset", "k")


def fitted(spark, sf_dir):
    """Parsed lines and the TF-IDF model fitted on all of them."""
    p = parsed_logs(spark, sf_dir)
    return p, sl.fit_tfidf(p)


@register("syslog_parse", SYSLOG + "SELECT k, timestamp, hostname, appname, pid, message FROM parsed")
def syslog_parse(spark, sf_dir):
    """Five fields per line; unmatched lines give empty strings."""
    return parsed_logs(spark, sf_dir).select("k", *schemas.SYSLOG_FIELDS)


@register("syslog_unmatched", SYSLOG + "SELECT k FROM parsed WHERE timestamp = ''")
def syslog_unmatched(spark, sf_dir):
    """Lines the pattern does not match (kept, flagged)."""
    return parsed_logs(spark, sf_dir).filter(~F.col("matched")).select("k")


@register(
    "syslog_tokens",
    SYSLOG + "SELECT k, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM toks",
)
def syslog_tokens(spark, sf_dir):
    """Lower-cased whitespace tokens of each message."""
    t = sl.tokenizer().transform(parsed_logs(spark, sf_dir))
    return t.select("k", F.size("tokenizedMessage").alias("n_tokens"), F.array_join("tokenizedMessage", " ").alias("tokens"))


@register(
    "syslog_no_stopwords",
    SYSLOG + "SELECT k, CAST(len(filtered) AS INTEGER) AS n_tokens, array_to_string(filtered, ' ') AS tokens FROM filt",
)
def syslog_no_stopwords(spark, sf_dir):
    """Tokens without stop words (case-insensitive, duplicates kept)."""
    t = sl.tokens(parsed_logs(spark, sf_dir))
    return t.select("k", F.size("filteredMessage").alias("n_tokens"), F.array_join("filteredMessage", " ").alias("tokens"))


@register("syslog_vocab", SYSLOG + "SELECT term, tf, rank FROM vocab")
def syslog_vocab(spark, sf_dir):
    """The vocabulary, most frequent terms first, ties by term."""
    return sl.vocabulary_counts(sl.tokens(parsed_logs(spark, sf_dir)))


@register("syslog_vocab_sketched", SYSLOG + "SELECT v.term, v.tf, n.df, v.rank FROM vocab v JOIN "
          "(SELECT term, count(DISTINCT k) AS df FROM (SELECT k, unnest(filtered) AS term FROM filt) GROUP BY term) n USING (term)")
def syslog_vocab_sketched(spark, sf_dir):
    """The same vocabulary with line counts, where only terms that a sketch finds frequent are counted."""
    counts = sl.frequent_term_counts(sl.tokens(parsed_logs(spark, sf_dir)), schemas.VOCAB_SIZE, 16_384)
    top = counts.filter("term is not null").orderBy(F.col("tf").desc(), F.col("term")).limit(schemas.VOCAB_SIZE)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("tf").desc(), F.col("term"))))


@register("syslog_tf", SYSLOG + "SELECT k, CAST(pos AS INTEGER) AS pos, x FROM tf")
def syslog_tf(spark, sf_dir):
    """T4: term counts over the vocabulary, non-zero entries in long form."""
    p, model = fitted(spark, sf_dir)
    return sl.sparse_entries(sl.score(p, model), "tfFeatures")


@register("syslog_idf", SYSLOG + "SELECT CAST(pos AS INTEGER) AS pos, CAST(idf AS DECIMAL(18, 9)) AS idf FROM idf")
def syslog_idf(spark, sf_dir):
    """T5: inverse document frequency per vocabulary term (0 below the minimum document count)."""
    p, model = fitted(spark, sf_dir)
    weights = [float(x) for x in model.stages[-1].getScalingVec().toArray()]  # vocab_size values
    rows = spark.createDataFrame(list(enumerate(weights)), "pos int, idf double")
    return rows.select("pos", F.col("idf").cast("decimal(18,9)").alias("idf"))


_TFIDF_SQL = SYSLOG + """
SELECT t.k, CAST(t.pos AS INTEGER) AS pos, CAST(t.x * i.idf AS DECIMAL(18, 9)) AS x
FROM tf t JOIN idf i USING (pos) WHERE i.idf <> 0"""


@register("syslog_tfidf", _TFIDF_SQL)
def syslog_tfidf(spark, sf_dir):
    """TF-IDF weights, non-zero entries in long form."""
    p, model = fitted(spark, sf_dir)
    e = sl.sparse_entries(sl.score(p, model), "tfidfFeatures")
    return e.select("k", "pos", F.col("x").cast("decimal(18,9)").alias("x"))


@register("syslog_model_roundtrip", _TFIDF_SQL)
def syslog_model_roundtrip(spark, sf_dir):
    """Save the fitted pipeline, load it back, score with the loaded model."""
    p, model = fitted(spark, sf_dir)
    path = scratch_path(spark, "tfidf-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    e = sl.sparse_entries(sl.score(p, loaded), "tfidfFeatures")
    return e.select("k", "pos", F.col("x").cast("decimal(18,9)").alias("x"))


@register("syslog_dense")
def syslog_dense(spark, sf_dir):
    """Dense TF-IDF vector per line, as text and as an array."""
    p, model = fitted(spark, sf_dir)
    s = sl.score(p, model)
    return s.select("k", sl.dense_text().alias("dense"), F.size(sl.dense_array()).alias("n_values"))


@register("syslog_line")
def syslog_line(spark, sf_dir):
    """The output record `timestamp,hostname,appname,pid,<dense values>`."""
    p, model = fitted(spark, sf_dir)
    s = sl.score(p, model)
    return sl.to_syslog_line(s, keep=("k",))


@register("syslog_csv_roundtrip", SYSLOG + "SELECT timestamp, hostname, appname, pid, message FROM parsed")
def syslog_csv_roundtrip(spark, sf_dir):
    """Parsed lines written as header-less CSV and read back with the fixed schema."""
    path = scratch_path(spark, "syslog-csv")
    sl.write_syslog_csv(parsed_logs(spark, sf_dir).select(*schemas.SYSLOG_FIELDS), path)
    return sl.read_syslog_csv(spark, path)


@register("syslog_preview", SYSLOG + "SELECT k, timestamp, hostname, appname, pid, message FROM parsed ORDER BY k LIMIT 5")
def syslog_preview(spark, sf_dir):
    """The first five parsed lines (a top-k by key; the limit is the feature)."""
    return parsed_logs(spark, sf_dir).select("k", *schemas.SYSLOG_FIELDS).orderBy("k").limit(5)


def line_values(lines):
    """``k, value`` records -> the non-zero values of the vector in the text, in long form."""
    text = F.regexp_extract("value", r"^(?:[^,]*,){4}(.*)$", 1)
    values = lines.select("k", F.posexplode(F.split(text, ", ")).alias("pos", "x")).withColumn("x", F.col("x").cast("double"))
    return values.filter("x <> 0").select("k", "pos", F.col("x").cast("decimal(18,9)").alias("x"))


@register("syslog_line_values", _TFIDF_SQL)
def syslog_line_values(spark, sf_dir):
    """The output records, read back, hold the TF-IDF weights."""
    return line_values(syslog_line(spark, sf_dir))


@register("syslog_dense_values", _TFIDF_SQL)
def syslog_dense_values(spark, sf_dir):
    """The dense text, read back, and the dense array hold the same weights."""
    p, model = fitted(spark, sf_dir)
    s = sl.score(p, model).select("k", F.split(sl.dense_text(), ", ").alias("text"), sl.dense_array().alias("array"))
    pairs = s.select("k", F.posexplode(F.arrays_zip("text", "array")).alias("pos", "v"))
    same = pairs.filter((F.col("v.array") != 0) & (F.col("v.text").cast("double") == F.col("v.array")))
    return same.select("k", "pos", F.col("v.array").cast("decimal(18,9)").alias("x"))
