"""Flow streams: one source, anonymized / preprocessed / both outputs.

Two ways to run the three outputs:

* ``start_netflow_fanout`` (default): one query whose ``foreachBatch`` parses
  each micro-batch once, builds the batch's mapping (distinct sensitive
  addresses only) and writes every output. The source is read once and the
  anonymization work is shared. The record outputs share a layout and are one
  write, ``<root>/records/batch=<run>-<b>/attempt=<id>/output=<name>``; the
  rejects and the mapping go to such folders of their own. A commit row is written
  after all of them, with counts, times and the offsets of the source. ``read_output`` reads
  only what is committed, so a reader sees all outputs of a batch or none; a
  retried batch writes a new attempt, and a committed one is not written again.
* ``start_netflow_queries``: three independent streaming queries, each with
  its own checkpoint folder (disjoint), without state. The pseudonyms of all
  addresses of a small policy are made once and broadcast; under a policy that
  covers more addresses than that they are computed inline for sensitive cells.

Records that cannot be parsed go to a ``rejects`` output in both forms.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netsift import schemas
from netsift.functions.cryptopan import Key
from netsift.operators import anonymize as anon
from netsift.operators import features as feat
from netsift.operators import flow as flowop
from netsift.operators import policy as pol
from netsift.operators.mapping_store import MappingStore
from netsift.session import path_exists

OUTPUTS = ("anonymized", "preprocessed", "both")


def _as_record(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Back to the envelope: original key and partition, the line as ``value``."""
    keep = [c for c in ("key", "partition", "offset") if c in df.columns]
    return df.select(*keep, flowop.to_flow_line(df, columns).alias("value"))


def netflow_outputs(
    parsed: DataFrame,
    *,
    policy: pol.Policy,
    key: Key | None = None,
    mapping: DataFrame | None = None,
    cols: Sequence[str] = schemas.DEFAULT_ANONYMIZE_COLUMNS,
    columns: Sequence[str] | None = None,
    anonymized: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The three outputs and the rejects of parsed flow records, as record DataFrames.

    ``anonymized`` may pass in the whole rows already anonymized.
    """
    columns = list(columns or schemas.flow_columns())
    derived = columns + list(schemas.DERIVED_COLUMNS)
    good = flowop.good_rows(parsed)
    whole = flowop.whole_rows(parsed, columns)  # short and null records are rejects only
    if anonymized is not None:
        pass
    elif mapping is not None:
        anonymized = anon.apply_mapping(whole, cols, mapping, policy=policy)
    elif (covered := anon.policy_mapping(policy, key) if key is not None else None) is not None:
        anonymized = anon.apply_policy_mapping(whole, cols, covered)
    else:
        anonymized = anon.apply_mapping(whole, cols, None, policy=policy, key=key, strategy="inline")
    return {
        "anonymized": _as_record(anonymized, columns),
        "preprocessed": _as_record(feat.add_features(good), derived),
        "both": _as_record(feat.add_features(flowop.good_rows(anonymized)), derived),
        "rejects": parsed.filter(F.col("reject_reason").isNotNull()).select(
            *[c for c in ("key", "partition", "offset") if c in parsed.columns], "reject_reason", "rejected_record"
        ),
    }


def fanout_batch(
    batch: DataFrame,
    batch_id: int,
    *,
    root: str,
    policy: pol.Policy,
    key: Key,
    cols: Sequence[str] = schemas.DEFAULT_ANONYMIZE_COLUMNS,
    columns: Sequence[str] | None = None,
    run: str = "0",
    store: MappingStore | None = None,
) -> None:
    """Parse one micro-batch once, write all outputs plus the batch's mapping, then commit them together.

    With a ``store`` only addresses never seen before are encrypted. A replay of a committed batch does nothing; one
    of a batch that failed writes a new attempt. A failure is recorded and raised.
    """
    spark, name, attempt, began = batch.sparkSession, f"{run}-{batch_id}", uuid.uuid4().hex[:12], time.time()
    if any(c.batch == name for c in commits(spark, root)):
        return
    names = list(columns or schemas.flow_columns())
    parsed = flowop.parse_flow(batch, columns, keep=("key", "partition", "offset")).persist()
    mapping, measured = None, {}
    try:
        whole = flowop.whole_rows(parsed, names)
        ips = anon.sensitive_ips(whole, cols, policy)
        mapping = (store.add(ips, name) if store is not None else anon.build_mapping(ips, key)).persist()
        # The mapping holds every sensitive (trimmed) cell of this very batch, so
        # no cell can be sensitive and unmapped: the per-cell policy check is skipped.
        records = _all_records(whole, cols, names, mapping)
        rejects = netflow_outputs(parsed, policy=policy, cols=cols, columns=columns, anonymized=whole)["rejects"]
        failed = F.sum(F.col("obfuscated_ip").isNull().cast("bigint"))
        counts = {
            "records": [F.sum((F.col("output") == o).cast("bigint")).alias(f"n_{o}") for o in OUTPUTS],
            "rejects": [F.count(F.lit(1)).alias("n_rejects")],
            "mapping": [F.count(F.lit(1)).alias("n_lookups"), F.coalesce(failed, F.lit(0)).alias("n_failed")],
        }
        for output, df in (("records", records), ("rejects", rejects), ("mapping", mapping)):
            seen, since = Observation(), time.time()
            w = df.observe(seen, *counts[output]).write.mode("overwrite")
            w = w.partitionBy("output") if output == "records" else w
            w.parquet(_folder(root, output, name, attempt))
            measured |= {k: v or 0 for k, v in seen.get.items()} | {f"{output}_seconds": time.time() - since}
        _commit(spark, root, "commits", {
            "batch": name, "attempt": attempt, "seconds": time.time() - began, "error": None, "offsets": _offsets(parsed), **measured})
    except Exception as e:
        _commit(spark, root, "failures", {
            "batch": name, "attempt": attempt, "seconds": time.time() - began, "error": f"{type(e).__name__}: {e}"[:2000], "offsets": [], **measured})
        raise
    finally:
        if mapping is not None:
            mapping.unpersist()
        parsed.unpersist()


_COUNTS = ("n_anonymized", "n_preprocessed", "n_both", "n_rejects", "n_lookups", "n_failed")
_TIMES = ("records_seconds", "rejects_seconds", "mapping_seconds")
_COMMIT = ("batch string, attempt string, seconds double, error string, offsets array<struct<partition:int,first:bigint,last:bigint,n:bigint>>, "
           + ", ".join([f"{c} bigint" for c in _COUNTS] + [f"{c} double" for c in _TIMES]))


def _folder(root: str, output: str, batch: str, attempt: str) -> str:
    return os.path.join(root, output, f"batch={batch}", f"attempt={attempt}")


def _offsets(parsed: DataFrame) -> list[tuple]:
    """For each partition of the source: the first and last offset of the batch, and how many records."""
    if not {"partition", "offset"} <= set(parsed.columns):
        return []
    found = parsed.groupBy("partition").agg(F.min("offset"), F.max("offset"), F.count(F.lit(1)))
    return [tuple(r) for r in found.collect()]  # one row for each partition


def _commit(spark: SparkSession, root: str, kind: str, row: dict) -> None:
    """One file of one row, made visible by a rename: with it a batch's outputs are there, all at once."""
    names = [f.split(" ")[0] for f in _COMMIT.split(", ")]
    made = spark.createDataFrame([tuple(row.get(n) for n in names)], _COMMIT).withColumn("committed_at", F.current_timestamp())
    made.coalesce(1).write.json(os.path.join(root, kind, f"{row['batch']}-{row['attempt']}"))


def _rows(spark: SparkSession, root: str, kind: str) -> list:
    path = os.path.join(root, kind)
    if not path_exists(spark, path):
        return []
    return spark.read.schema(_COMMIT + ", committed_at timestamp").json(os.path.join(path, "*")).collect()  # one row a batch


def commits(spark: SparkSession, root: str) -> list:
    """The commit rows of the fan-out, the first attempt of each batch."""
    first: dict = {}
    for c in sorted(_rows(spark, root, "commits"), key=lambda c: (c.committed_at, c.attempt)):
        first.setdefault(c.batch, c)
    return list(first.values())


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """One row for each attempt (K8): ``batch, result, lookups, failed, rows`` of each output, ``seconds`` in all and for each write, ``error``."""
    rows = [("committed", c) for c in commits(spark, root)] + [("failed", c) for c in _rows(spark, root, "failures")]
    made = [(c.batch, result, *[c[n] for n in _COUNTS], c.seconds, *[c[n] for n in _TIMES], c.error, c.committed_at) for result, c in rows]
    shape = "batch string, result string, " + ", ".join([f"{c} bigint" for c in _COUNTS] + ["seconds double"] + [f"{c} double" for c in _TIMES])
    return spark.createDataFrame(made, shape + ", error string, ended_at timestamp")


def not_committed(batch: DataFrame, root: str, run: str) -> DataFrame:
    """The records of a batch that no committed batch of another run holds, by ``(partition, offset)``.

    A committed batch that holds all offsets between its first and last is one range; of others the
    offsets themselves are read from what it wrote.
    """
    spark, spans, apart = batch.sparkSession, {}, []
    for c in commits(spark, root):
        if c.batch.startswith(f"{run}-"):
            continue
        if all(o.n == o.last - o.first + 1 for o in c.offsets):
            for o in c.offsets:
                spans.setdefault(o.partition, []).append((o.first, o.last))
        else:
            apart.append(c)
    merged = []
    for partition, ranges in spans.items():
        own: list[list[int]] = []
        for a, b in sorted(ranges):
            if own and a <= own[-1][1] + 1:
                own[-1][1] = max(own[-1][1], b)
            else:
                own.append([a, b])
        merged += [(partition, a, b) for a, b in own]
    if merged:  # a range for each gap-free stretch of a partition
        done = spark.createDataFrame(merged, "_p int, _a bigint, _b bigint")
        batch = batch.join(F.broadcast(done), (F.col("partition") == F.col("_p")) & F.col("offset").between(F.col("_a"), F.col("_b")), "left_anti")
    if apart:
        held = _read(spark, root, "records", apart).filter("output = 'anonymized'").select("partition", "offset")
        some = [c for c in apart if c.n_rejects]
        if some:
            held = held.unionByName(_read(spark, root, "rejects", some).select("partition", "offset"))
        batch = batch.join(held.distinct(), ["partition", "offset"], "left_anti").select(*batch.columns)
    return batch


def _all_records(whole: DataFrame, cols: Sequence[str], columns: Sequence[str], mapping: DataFrame) -> DataFrame:
    """The rows of all three record outputs with ``output``, in one pass: each record's lines are made side by side."""
    derived = [*columns, *schemas.DERIVED_COLUMNS]
    good = F.col("reject_reason").isNull()
    rows = feat.add_features(whole)
    rows = rows.withColumn("_clear", F.when(good, flowop.to_flow_line(rows, derived)))
    rows = anon.apply_mapping(rows, cols, mapping, unique=True)
    lines = {"anonymized": flowop.to_flow_line(rows, columns), "preprocessed": F.col("_clear"), "both": F.when(good, flowop.to_flow_line(rows, derived))}
    made = F.explode(F.array(*[F.struct(F.lit(name).alias("output"), lines[name].alias("value")) for name in OUTPUTS]))
    keep = [c for c in ("key", "partition", "offset") if c in rows.columns]
    return rows.select(*keep, made.alias("_r")).select(*keep, "_r.value", "_r.output").filter("value is not null")


def _read(spark: SparkSession, root: str, output: str, which: list) -> DataFrame:
    paths = [_folder(root, output, c.batch, c.attempt) for c in which]
    return spark.read.option("basePath", os.path.join(root, output)).parquet(*paths)


def read_output(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One output of the fan-out, of committed batches only: a record output by name, ``rejects`` or ``mapping``."""
    kind = "records" if name in OUTPUTS else name
    count = {"mapping": "n_lookups"}.get(name, f"n_{name}")
    done = commits(spark, root)
    # folders without rows hold no schema
    some = [c for c in done if (any(c[f"n_{o}"] for o in OUTPUTS) if kind == "records" else c[count])]
    if not some:
        shapes = {"rejects": "key binary, partition int, offset bigint, reject_reason string, rejected_record string, batch string",
                  "mapping": "original_ip string, obfuscated_ip string, family int, n_cells bigint, batch string"}
        return spark.createDataFrame([], shapes.get(name, "key binary, partition int, offset bigint, value string, batch string"))
    found = _read(spark, root, kind, some).drop("attempt")
    return found.filter(F.col("output") == name).drop("output") if kind == "records" else found


def start_netflow_fanout(
    source: DataFrame,
    *,
    root: str,
    checkpoint: str,
    policy: pol.Policy,
    key: Key,
    cols: Sequence[str] = schemas.DEFAULT_ANONYMIZE_COLUMNS,
    columns: Sequence[str] | None = None,
    available_now: bool = False,
    name: str = "netflow-fanout",
    run: str = "0",
    resume: bool = False,
    store: MappingStore | None = None,
) -> StreamingQuery:
    """One query, all outputs (K9 with shared parsing and mapping).

    ``run`` goes into the names of batches, since a new checkpoint counts them from 0 again: a query that
    goes on after its checkpoint is lost needs a new ``run`` and ``resume=True``. Its source is then read from the
    start, and records that committed batches of other runs hold are passed over.
    """

    def each(batch, batch_id):
        some = not_committed(batch, root, run) if resume else batch
        fanout_batch(some, batch_id, root=root, policy=policy, key=key, cols=cols, columns=columns, run=run, store=store)

    w = source.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(each)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def start_netflow_queries(
    source: DataFrame,
    *,
    sinks: dict[str, dict],
    checkpoint_root: str,
    policy: pol.Policy,
    key: Key,
    cols: Sequence[str] = schemas.DEFAULT_ANONYMIZE_COLUMNS,
    columns: Sequence[str] | None = None,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Independent queries (K1-K3, R1, R3-R5): ``sinks[name] = {"format": ..., **options}``.

    Every query gets its own checkpoint folder ``<checkpoint_root>/<name>``.
    """
    parsed = flowop.parse_flow(source, columns, keep=("key", "partition", "offset"))
    outs = netflow_outputs(parsed, policy=policy, key=key, cols=cols, columns=columns)
    started = []
    for name, spec in sinks.items():
        spec = dict(spec)
        fmt = spec.pop("format", "parquet")
        df = outs[name]
        if fmt == "kafka":
            df = kafka_records(df)
        w = (df.writeStream.queryName(f"netflow-{name}").format(fmt).outputMode("append")
             .option("checkpointLocation", os.path.join(checkpoint_root, name)).options(**spec))
        if available_now:
            w = w.trigger(availableNow=True)
        started.append(w.start())
    return started


def kafka_records(df: DataFrame) -> DataFrame:
    """The columns a Kafka sink takes, with a binary value."""
    keep = [c for c in ("key", "partition", "topic") if c in df.columns]
    return df.select(*keep, F.col("value").cast("binary").alias("value"))


def await_all(spark: SparkSession, queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until every query ends; the first failure stops the others and raises.

    With ``timeout`` (seconds) queries still running then are stopped.
    """
    end = None if timeout is None else time.monotonic() + timeout
    try:
        while any(q.isActive for q in queries):
            failed = [q for q in queries if not q.isActive and q.exception() is not None]
            if failed or (end is not None and time.monotonic() >= end):
                break
            try:  # returns when any query of the session ends, or after a while
                spark.streams.awaitAnyTermination(1.0 if end is None else max(0.01, min(1.0, end - time.monotonic())))
            except StreamingQueryException:
                pass  # of one of these, which is seen above, or of another query of the session
            spark.streams.resetTerminated()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        if q.exception() is not None:
            raise RuntimeError(f"streaming query {q.name} failed: {q.exception()}")
