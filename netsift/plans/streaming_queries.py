"""Registered streaming queries: a file source of envelopes, availableNow runs, outputs read back."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from netsift import fixtures, schemas
from netsift.operators import anonymize as anon
from netsift.operators import flow as flowop
from netsift.operators import policy as pol
from netsift.operators.mapping_store import MappingStore
from netsift.plans import duck
from netsift.plans.common import FLOW_CTE, POLICY, SAMPLE_KEY, with_cte
from netsift.plans.registry import ORACLE, register
from netsift.plans.syslog_queries import line_values, parsed_logs
from netsift.operators import syslog as sl
from netsift.session import scratch_path
from netsift.sources.envelope import read_envelope, read_snapshot
from netsift.streaming import netflow as snf
from netsift.streaming import syslog as ssl

FILES_PER_BATCH = 2
#: Rows, and bytes of text, in a file of a source: files grow in number with the data, not in size.
FILE_ROWS, FILE_BYTES = 50_000, 64 << 20


def _n_files(table, least, text=None):
    """How many files a source of a table's rows has, ``least`` at least."""
    size = F.coalesce(F.sum(F.octet_length(text)) if text else F.lit(0), F.lit(0))
    n, size = table.agg(F.count(F.lit(1)), size).first()
    return max(least, -(-n // FILE_ROWS), -(-size // FILE_BYTES))


def _files_per_batch(spark):
    """A micro-batch has four files for each core, so that few cores wait for its last ones."""
    return max(FILES_PER_BATCH, 4 * spark.sparkContext.defaultParallelism)


def _source(spark, env, name, n_files):
    """Envelope rows written as parquet files, then opened as a stream (several micro-batches)."""
    path = scratch_path(spark, name)
    env.repartition(n_files).write.parquet(path)
    batch = min(-(-n_files // 2), _files_per_batch(spark))
    return read_envelope(spark, "parquet", streaming=True, path=path, options={"maxFilesPerTrigger": str(batch)})


def _flow_source(spark, sf_dir):
    n_files = _n_files(fixtures.table(spark, sf_dir, "events"), 2 * FILES_PER_BATCH)
    return _source(spark, fixtures.flow_envelope(spark, sf_dir), "flow-source", n_files)


def _run_fanout(spark, sf_dir):
    root = scratch_path(spark, "flow-out")
    q = snf.start_netflow_fanout(
        _flow_source(spark, sf_dir),
        root=root,
        checkpoint=scratch_path(spark, "flow-ckpt"),
        policy=pol.read_policy(spark, lines=POLICY),
        key=SAMPLE_KEY,
        available_now=True,
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return root


@register(
    "stream_fanout_counts",
    with_cte(FLOW_CTE) + """
SELECT 'anonymized' AS output, count(*) AS n FROM flow
UNION ALL SELECT 'preprocessed', count(*) FROM flow WHERE dp <> ''
UNION ALL SELECT 'both', count(*) FROM flow WHERE dp <> ''
UNION ALL SELECT 'rejects', count(*) FROM flow WHERE dp = ''""",
)
def stream_fanout_counts(spark, sf_dir):
    """One streaming query writes all outputs; rows per output."""
    root = _run_fanout(spark, sf_dir)
    parts = [snf.read_output(spark, root, name).select(F.lit(name).alias("output")) for name in
             ("anonymized", "preprocessed", "both", "rejects")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("output").agg(F.count(F.lit(1)).alias("n"))


@register("stream_fanout_preprocessed", ORACLE["flow_append_line"])
def stream_fanout_preprocessed(spark, sf_dir):
    """K2 through the fan-out: the preprocessed records equal the batch result."""
    root = _run_fanout(spark, sf_dir)
    return snf.read_output(spark, root, "preprocessed").select(F.col("offset").alias("k"), F.col("value").alias("line"))


@register("stream_fanout_both")
def stream_fanout_both(spark, sf_dir):
    """K3 through the fan-out: anonymized and preprocessed records."""
    root = _run_fanout(spark, sf_dir)
    return snf.read_output(spark, root, "both").select(F.col("offset").alias("k"), F.col("value").alias("line"))


@register("stream_queries_preprocessed", ORACLE["flow_append_line"])
def stream_queries_preprocessed(spark, sf_dir):
    """Three independent queries with disjoint checkpoints; the preprocessed one read back."""
    root = scratch_path(spark, "flow-q-out")
    sinks = {name: {"format": "parquet", "path": os.path.join(root, name)} for name in snf.OUTPUTS}
    qs = snf.start_netflow_queries(
        _flow_source(spark, sf_dir),
        sinks=sinks,
        checkpoint_root=scratch_path(spark, "flow-q-ckpt"),
        policy=pol.read_policy(spark, lines=POLICY),
        key=SAMPLE_KEY,
        available_now=True,
    )
    snf.await_all(spark, qs)
    return spark.read.parquet(os.path.join(root, "preprocessed")).select(F.col("offset").alias("k"), F.col("value").alias("line"))


@register("stream_syslog_lines")
def stream_syslog_lines(spark, sf_dir):
    """Log lines scored by a fitted model on a stream; the output records."""
    p = parsed_logs(spark, sf_dir)
    model = sl.fit_tfidf(p)
    n_files = _n_files(fixtures.table(spark, sf_dir, "documents"), 2 * FILES_PER_BATCH, "text")
    source = _source(spark, fixtures.syslog_envelope(spark, sf_dir), "syslog-source", n_files)
    out = scratch_path(spark, "syslog-out")
    lines = ssl.syslog_lines(source, model, keep=("offset",))
    q = (lines.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "syslog-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select(F.col("offset").alias("k"), "value")


@register("stream_syslog_values", ORACLE["syslog_tfidf"])
def stream_syslog_values(spark, sf_dir):
    """K4: the streamed records, read back, hold the TF-IDF weights."""
    return line_values(stream_syslog_lines(spark, sf_dir))


@register("stream_fanout_anonymized_checked", with_cte(FLOW_CTE) + "SELECT k, line FROM flow_line")
def stream_fanout_anonymized_checked(spark, sf_dir):
    """K1 A5: the anonymized records of the fan-out, with their addresses put back through its mappings."""
    root = _run_fanout(spark, sf_dir)
    records = snf.read_output(spark, root, "anonymized").select("offset", F.col("value").cast("binary").alias("value"))
    mapping = anon.materialize(snf.read_output(spark, root, "mapping").select("original_ip", "obfuscated_ip").distinct())
    back = anon.deanonymize(flowop.parse_flow(records, keep=("offset",)), schemas.DEFAULT_ANONYMIZE_COLUMNS, mapping)
    return back.select(F.col("offset").alias("k"), flowop.to_flow_line(back, schemas.flow_columns()).alias("line"))


def _run_twice(spark, sf_dir):
    """A first run that ends after one batch; its checkpoint is lost, and a second run starts anew and resumes from the commits."""
    path, root, store = (scratch_path(spark, x) for x in ("flow-source", "flow-out", "mapping-store"))
    env = fixtures.flow_envelope(spark, sf_dir)
    kept = MappingStore(spark, store, SAMPLE_KEY, n_buckets=4)
    # each run writes so many files, which are one batch
    n_files = _n_files(fixtures.table(spark, sf_dir, "events"), FILES_PER_BATCH)
    for run, part in (("0", "offset % 5 < 2"), ("1", "offset % 5 >= 2")):
        env.filter(part).repartition(n_files).write.mode("append").parquet(path)
        source = read_envelope(spark, "parquet", streaming=True, path=path, options={"maxFilesPerTrigger": str(n_files)})
        q = snf.start_netflow_fanout(source, root=root, checkpoint=scratch_path(spark, "flow-ckpt"), policy=pol.read_policy(spark, lines=POLICY),
                                     key=SAMPLE_KEY, available_now=True, run=run, resume=run != "0", store=kept)
        snf.await_all(spark, [q])
    return root


@register("stream_fanout_recovered", ORACLE["flow_append_line"])
def stream_fanout_recovered(spark, sf_dir):
    """After a lost checkpoint every record is there once, by the offsets of the commits."""
    out = snf.read_output(spark, _run_twice(spark, sf_dir), "preprocessed")
    return out.select(F.col("offset").alias("k"), F.col("value").alias("line"))


@register(
    "stream_fanout_audit",
    with_cte(FLOW_CTE) + f"""
, cell AS (SELECT k % 5 < 2 AS early, trim(sa) AS ip FROM flow UNION ALL SELECT k % 5 < 2, trim(da) FROM flow),
looked AS (SELECT early, count(DISTINCT ip) AS n FROM cell WHERE {duck.membership('ip', POLICY)} GROUP BY early)
SELECT CASE WHEN k % 5 < 2 THEN '0' ELSE '1' END AS run, 'committed' AS result, count(*) AS n_anonymized,
  count(*) FILTER (WHERE dp <> '') AS n_preprocessed, count(*) FILTER (WHERE dp <> '') AS n_both,
  count(*) FILTER (WHERE dp = '') AS n_rejects, any_value(n) AS n_lookups, 0::BIGINT AS n_failed, true AS timed
FROM flow JOIN looked ON early = (k % 5 < 2) GROUP BY 1""",
)
def stream_fanout_audit(spark, sf_dir):
    """K8: what each run looked up and wrote, measured as it was written, with times (the runs' batches hold all their files)."""
    rows = snf.read_audit(spark, _run_twice(spark, sf_dir)).filter("n_anonymized > 0")
    timed = (F.col("seconds") > 0) & (F.col("records_seconds") > 0) & (F.col("mapping_seconds") > 0) & F.col("ended_at").isNotNull()
    return rows.select(F.substring_index("batch", "-", 1).alias("run"), "result", *[f"n_{x}" for x in (*snf.OUTPUTS, "rejects", "lookups", "failed")], timed.alias("timed"))


_SNAPSHOT = {0: (30, 600), 1: ("earliest", 500), 2: (200, "latest")}


@register(
    "envelope_snapshot",
    with_cte(FLOW_CTE) + """
SELECT k AS "offset", CAST(k % 3 AS INTEGER) AS "partition", line AS value FROM flow_line
WHERE CASE k % 3 WHEN 0 THEN k >= 30 AND k < 600 WHEN 1 THEN k < 500 ELSE k >= 200 END""",
)
def envelope_snapshot(spark, sf_dir):
    """A snapshot between offsets of each partition stays the same while records are added to the files."""
    path = scratch_path(spark, "topic")
    env = fixtures.flow_envelope(spark, sf_dir)
    env.repartitionByRange(6, "partition", "offset").write.parquet(path)
    # the fixture's offsets of a partition are three apart; no gap is looked for
    snapshot = read_snapshot(spark, path, start={p: a for p, (a, _) in _SNAPSHOT.items()}, end={p: b for p, (_, b) in _SNAPSHOT.items()})
    env.withColumn("offset", F.col("offset") + 10_000_000).write.mode("append").parquet(path)
    return snapshot.select("offset", "partition", F.col("value").cast("string").alias("value"))


@register("stream_fanout_both_checked", ORACLE["flow_append_line"])
def stream_fanout_both_checked(spark, sf_dir):
    """K3 A5: the anonymized and preprocessed records, with their addresses put back through the batch mappings."""
    root = _run_fanout(spark, sf_dir)
    both = snf.read_output(spark, root, "both")
    columns = schemas.flow_columns()
    cells = flowop.parse_flow(both.select("offset", F.col("value").cast("binary").alias("value")), keep=("offset",))
    mapping = snf.read_output(spark, root, "mapping").select("original_ip", "obfuscated_ip").distinct()
    mapping = anon.materialize(mapping)  # no clear address of these flows equals a pseudonym
    back = anon.deanonymize(cells, schemas.DEFAULT_ANONYMIZE_COLUMNS, mapping)
    return back.select(F.col("offset").alias("k"), flowop.to_flow_line(back, columns).alias("line"))
