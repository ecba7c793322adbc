"""Corpus pipeline: toxicity, line dedup, SimHash dedup, suffix-array dedup, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all its predecessor kept and returns a DataFrame; all but the last
return the columns of ``documents`` with ``n_chars`` of the text as it then is. ``run`` writes each result as Parquet in the shared folder and reads it
again for the next stage.

Defined results: rows with a null or empty text go through every stage and are packed as the end id alone (all of them are one SimHash
group, so one with an id stays). Rows with a null id are never chosen for, nor removed by, a SimHash group; of rows repeating an id one stays
there for each group that the id names. An empty table gives no rows. Extra columns are carried to the last stage but one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.llm.common import free_names, materialize
from netsift.llm.line_dedup import drop_lines
from netsift.llm.packing import pack_documents
from netsift.llm.simhash_dedup import add_fingerprints, simhash_groups
from netsift.llm.suffix_dedup import cut_repeats
from netsift.llm.toxicity import THRESHOLD, fit_toxicity, toxicity_score
from netsift.session import scratch_path

BATCH_ROWS = 1000


def _bounded(spark: SparkSession) -> None:
    """Batches of at most ``BATCH_ROWS`` rows between the JVM and Python: with whole texts in them, they are what a stage holds in memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _as_documents(result: DataFrame, docs: DataFrame) -> DataFrame:
    out = result.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else result
    return out.select(*[f"`{c}`" for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the given labels of these documents, rejects go."""
    _bounded(spark)
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity_score(F.col("text"), model) < THRESHOLD)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go."""
    _bounded(spark)
    return _as_documents(drop_lines(docs), docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates stays."""
    _bounded(spark)
    groups = materialize(simhash_groups(docs.select("doc_id", "text"), with_root=True))
    marked = groups.filter("doc_id = component_id")
    apart = groups.groupBy("doc_id").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("doc_id is not null and lo < hi")
    apart = materialize(apart.select("doc_id"))
    columns = [f"`{c}`" for c in docs.columns]
    stays = docs.join(marked.join(apart, "doc_id", "left_anti").select("doc_id").distinct(), "doc_id", "left_semi").select(*columns)
    stays = _first_of(stays, "doc_id").unionByName(docs.filter("doc_id is null"))
    if apart.isEmpty():
        return stays
    # rows of one id in several groups: their fingerprints tell which row is in which
    text, mark, root = free_names(docs.columns, "__text", "__print", "__root")
    rows = docs.join(apart, "doc_id", "left_semi").select(*columns, F.coalesce("text", F.lit("")).alias(text))
    prints = add_fingerprints(rows.select(text).distinct(), text, text)
    prints = prints.select(F.col("id").alias(text), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias(mark))
    named = marked.select("doc_id", F.col("fingerprint").alias(mark), F.col("root").alias(root)).distinct()
    rows = _first_of(rows.join(prints, text).join(named, ["doc_id", mark]), "doc_id", root)
    return stays.unionByName(rows.select(*columns))


def _first_of(rows: DataFrame, *keys: str) -> DataFrame:
    (name,) = free_names(rows.columns, "__nth")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("text")))
    return rows.withColumn(name, nth).filter(F.col(name) == 1).drop(name)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages of 50 bytes that start in an earlier document go."""
    _bounded(spark)
    return _as_documents(cut_repeats(docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of 1024."""
    _bounded(spark)
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

#: SQL cannot express a trained model, byte matches or packing; tests/llm/test_pipeline.py has the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
