from pyspark.sql import Window
from pyspark.sql import functions as F

from netsift.operators import ordering


def test_positions_equal_global_row_number(spark):
    df = spark.range(0, 5000).select(
        F.encode(F.lpad((F.col("id") * 7919 % 1009).cast("string"), 5, "0"), "UTF-8").alias("key"),
        (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"))
    got = ordering.with_position(ordering.order_by_key(df, n_ranges=7)).select("partition", "offset", "pos")
    w = Window.orderBy("key", "partition", "offset")
    expected = df.select("partition", "offset", F.row_number().over(w).cast("bigint").alias("pos"))
    assert sorted(got.collect()) == sorted(expected.collect())


def test_ranges_are_ordered(spark):
    df = spark.range(0, 2000).select(F.encode((F.col("id") * 31 % 997).cast("string"), "UTF-8").alias("key"),
                                     F.lit(0).alias("partition"), F.col("id").alias("offset"))
    ordered = ordering.order_by_key(df, n_ranges=4)
    parts = ordered.rdd.glom().map(lambda rows: [bytes(r.key) for r in rows]).collect()
    flat = [k for p in parts for k in p]
    assert flat == sorted(flat)


def test_single_partition_option(spark):
    df = spark.range(100).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("key"))
    assert ordering.order_by_key(df, single=True).rdd.getNumPartitions() == 1


def test_ordered_snapshot_from_and_to_envelope_files(spark, tmp_path):
    from netsift import fixtures
    from netsift.sources.envelope import kafka_options, read_envelope, write_envelope

    env = fixtures.flow_envelope(spark, "/root/testdata/sf0.001")
    write_envelope(env, "parquet", path=str(tmp_path / "in"))
    snapshot = read_envelope(spark, "parquet", path=str(tmp_path / "in"))
    ordering.write_ordered(snapshot, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*.parquet"))
    keys = [bytes(r.key) for p in parts for r in spark.read.parquet(str(p)).collect()]
    assert keys == sorted(bytes(r.key) for r in env.collect())
    assert kafka_options("h:1", "t", starting_offsets="earliest", fail_on_data_loss=True) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "true"}
