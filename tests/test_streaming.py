from pyspark.sql import functions as F

from netsift import fixtures
from netsift.operators import policy as pol
from netsift.plans.common import POLICY, SAMPLE_KEY
from netsift.sources.envelope import read_envelope
from netsift.streaming import netflow as snf

SMALL = "/root/testdata/sf0.001"


def test_stream_fanout_equals_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    env = fixtures.flow_envelope(spark, SMALL)
    env.repartition(3).write.parquet(src)
    policy = pol.read_policy(spark, lines=POLICY)
    stream = read_envelope(spark, "parquet", streaming=True, path=src, options={"maxFilesPerTrigger": "1"})
    root = str(tmp_path / "out")
    q = snf.start_netflow_fanout(stream, root=root, checkpoint=str(tmp_path / "ck"), policy=policy,
                                 key=SAMPLE_KEY, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    from netsift.operators import flow as flowop

    batch = snf.netflow_outputs(flowop.parse_flow(env), policy=policy, key=SAMPLE_KEY)
    for name in ("anonymized", "preprocessed", "both"):
        got = snf.read_output(spark, root, name).select("offset", "value")
        exp = batch[name].select("offset", "value")
        assert sorted(got.collect()) == sorted(exp.collect()), name
    assert snf.read_output(spark, root, "rejects").count() == env.filter(F.lit(True)).count() - \
        snf.read_output(spark, root, "preprocessed").count()


def test_replayed_batch_replaces_its_own_files(spark, tmp_path):
    env = fixtures.flow_envelope(spark, SMALL, line=fixtures.RAGGED_LINE)
    policy, root = pol.read_policy(spark, lines=POLICY), str(tmp_path / "out")
    for batch_id in (0, 1, 1):
        part = env.filter(F.col("offset") % 2 == batch_id)
        snf.fanout_batch(part, batch_id, root=root, policy=policy, key=SAMPLE_KEY)
    counts = {n: snf.read_output(spark, root, n).count() for n in (*snf.OUTPUTS, "rejects")}
    rejects = snf.read_output(spark, root, "rejects")
    short = rejects.filter("reject_reason like 'fewer%' or reject_reason = 'null record'").count()
    assert counts["anonymized"] == env.count() - short
    assert counts["preprocessed"] == counts["both"] == env.count() - counts["rejects"]
    assert rejects.filter("rejected_record is null").count() == rejects.filter("reject_reason = 'null record'").count()


def test_restart_from_the_checkpoint(spark, tmp_path):
    env, src, root = fixtures.flow_envelope(spark, SMALL), str(tmp_path / "src"), str(tmp_path / "out")
    policy = pol.read_policy(spark, lines=POLICY)

    def run():
        stream = read_envelope(spark, "parquet", streaming=True, path=src)
        q = snf.start_netflow_fanout(stream, root=root, checkpoint=str(tmp_path / "ck"), policy=policy, key=SAMPLE_KEY, available_now=True)
        snf.await_all(spark, [q])
        return sorted(r.offset for r in snf.read_output(spark, root, "anonymized").collect())

    env.filter("offset < 300").write.mode("append").parquet(src)
    assert run() == list(range(300))
    env.filter("offset >= 300 and offset < 500").write.mode("append").parquet(src)
    assert run() == list(range(500))
    assert run() == list(range(500))  # nothing new: nothing written twice


def test_a_failing_query_stops_the_others(spark, tmp_path):
    import pytest

    src = str(tmp_path / "src")
    fixtures.flow_envelope(spark, SMALL).limit(10).write.parquet(src)
    stream = read_envelope(spark, "parquet", streaming=True, path=src)

    def fail(batch, batch_id):
        raise ValueError("told to fail")

    good = stream.writeStream.queryName("good").format("noop").option("checkpointLocation", str(tmp_path / "a")).start()
    bad = stream.writeStream.queryName("bad").foreachBatch(fail).option("checkpointLocation", str(tmp_path / "b")).start()
    with pytest.raises(RuntimeError, match="bad failed"):
        snf.await_all(spark, [good, bad], timeout=60)
    assert not good.isActive and not bad.isActive


def test_timed_run_stops(spark, tmp_path):
    stream = spark.readStream.format("rate").load()
    q = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).start()
    snf.await_all(spark, [q], timeout=2)
    assert not q.isActive


def test_kafka_records(spark):
    env = fixtures.flow_envelope(spark, SMALL)
    out = snf.kafka_records(env.withColumn("value", F.col("value").cast("string")))
    assert out.columns == ["key", "partition", "topic", "value"] and dict(out.dtypes)["value"] == "binary"


def test_syslog_stream_with_console_preview(spark, tmp_path):
    from netsift.operators import syslog as sl
    from netsift.streaming import syslog as ssl

    src = str(tmp_path / "src")
    fixtures.syslog_envelope(spark, SMALL).write.parquet(src)
    model = sl.fit_tfidf(sl.parse_syslog(spark.read.parquet(src)))
    stream = read_envelope(spark, "parquet", streaming=True, path=src)
    queries = ssl.start_syslog(stream, model, fmt="parquet", checkpoint=str(tmp_path / "ck"), options={"path": str(tmp_path / "out")},
                               console=True, available_now=True, name="log lines")
    snf.await_all(spark, queries, timeout=120)
    assert [q.name for q in queries][0] == "log lines" and len(queries) == 2
    want = ssl.syslog_lines(spark.read.parquet(src), model)
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(r.value for r in want.collect())


def test_outputs_of_a_batch_are_seen_together_or_not_at_all(spark, tmp_path, monkeypatch):
    import pytest

    env = fixtures.flow_envelope(spark, SMALL, line=fixtures.RAGGED_LINE)
    policy, root = pol.read_policy(spark, lines=POLICY), str(tmp_path / "out")
    snf.fanout_batch(env.filter("offset % 2 = 0"), 0, root=root, policy=policy, key=SAMPLE_KEY)
    names = (*snf.OUTPUTS, "rejects", "mapping")
    before = {n: snf.read_output(spark, root, n).count() for n in names}
    assert all(before.values())
    folder = snf._folder

    def fail(root, output, batch, attempt):  # after the records, before the rejects
        if output == "rejects":
            raise OSError("lost")
        return folder(root, output, batch, attempt)

    monkeypatch.setattr(snf, "_folder", fail)
    odd = env.filter("offset % 2 = 1")
    with pytest.raises(OSError):
        snf.fanout_batch(odd, 1, root=root, policy=policy, key=SAMPLE_KEY)
    monkeypatch.setattr(snf, "_folder", folder)
    assert {n: snf.read_output(spark, root, n).count() for n in names} == before
    snf.fanout_batch(odd, 1, root=root, policy=policy, key=SAMPLE_KEY)
    offsets = [r.offset for n in ("anonymized", "rejects") for r in snf.read_output(spark, root, n).collect()]
    assert set(offsets) == {r.offset for r in env.collect()}
    kept = [r.offset for r in snf.read_output(spark, root, "anonymized").collect()]
    assert len(kept) == len(set(kept))
    audit = sorted((r.batch, r.result, r.n_failed, r.error) for r in snf.read_audit(spark, root).collect())
    assert audit == [("0-0", "committed", 0, None), ("0-1", "committed", 0, None), ("0-1", "failed", None, "OSError: lost")]


def test_not_committed_by_ranges_and_by_offsets(spark, tmp_path):
    env = fixtures.flow_envelope(spark, SMALL).withColumn("partition", F.lit(0))
    policy, root = pol.read_policy(spark, lines=POLICY), str(tmp_path / "out")
    snf.fanout_batch(env.filter("offset < 100"), 0, root=root, policy=policy, key=SAMPLE_KEY)  # a range
    snf.fanout_batch(env.filter("offset >= 100 and offset < 200 and offset % 2 = 0"), 1, root=root, policy=policy, key=SAMPLE_KEY)  # with gaps
    left = {r.offset for r in snf.not_committed(env, root, "1").collect()}
    assert left == {r.offset for r in env.filter("offset >= 200 or (offset >= 100 and offset % 2 = 1)").collect()}
    assert snf.not_committed(env, root, "0").count() == env.count()
    assert snf.not_committed(env, root, "1").columns == env.columns


def test_snapshots(spark, tmp_path):
    import pytest

    from netsift.sources.envelope import read_snapshot

    path = str(tmp_path / "topic")
    env = fixtures.flow_envelope(spark, SMALL).filter("offset < 300").withColumn("partition", F.when(F.col("offset") < 200, 0).otherwise(1))
    env.write.parquet(path)
    assert read_snapshot(spark, path).count() == 300
    assert read_snapshot(spark, path, start="latest").count() == 0
    assert read_snapshot(spark, path, start="latest", fail_on_data_loss=True).count() == 0
    some = read_snapshot(spark, path, start={0: 150}, end={1: 210}, fail_on_data_loss=True)
    assert sorted(r.offset for r in some.collect()) == list(range(150, 210))
    assert "PushedFilters: [Or(" in some._jdf.queryExecution().toString()
    for bad in ({"end": {0: 201}}, {"start": {1: 199}}, {"end": {7: 5}}):
        assert read_snapshot(spark, path, **bad).count() >= 300
        with pytest.raises(ValueError, match="gone"):
            read_snapshot(spark, path, fail_on_data_loss=True, **bad)
    with pytest.raises(ValueError, match="unknown offset"):
        read_snapshot(spark, path, start="newest")
    gap = str(tmp_path / "gap")
    env.filter("offset <> 50").write.parquet(gap)
    assert read_snapshot(spark, gap).count() == 299
    with pytest.raises(ValueError, match="holds 199 of the 200"):
        read_snapshot(spark, gap, fail_on_data_loss=True)


def test_files_of_a_source_grow_in_number(spark):
    from netsift.plans.registry import load_all

    load_all()
    from netsift.plans import streaming_queries as sq

    assert sq._n_files(spark.range(10), 4) == 4
    assert sq._n_files(spark.range(0).selectExpr("cast(id as string) AS t"), 4, "t") == 4
    assert sq._n_files(spark.range(10 * sq.FILE_ROWS + 1), 4) == 11
    assert sq._n_files(spark.range(5).selectExpr(f"repeat('x', {sq.FILE_BYTES}) AS t"), 2, "t") == 5


def test_streams_under_a_small_policy_call_no_cipher(spark):
    from netsift.operators import flow as flowop

    policy = pol.read_policy(spark, lines=POLICY)
    outs = snf.netflow_outputs(flowop.parse_flow(fixtures.flow_envelope(spark, SMALL)), policy=policy, key=SAMPLE_KEY)
    for name in ("anonymized", "both"):
        assert "aes_encrypt" not in outs[name]._jdf.queryExecution().optimizedPlan().toString()
