from netsift.session import ensure_checkpoint_dir, spread


def test_spread_moves_a_few_splits_at_most(spark):
    for n in (9, 32):
        many = spark.range(0, 1000, numPartitions=n)
        assert spread(many, 1000).rdd.getNumPartitions() == n  # already split: untouched, no shuffle
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one, 8).rdd.getNumPartitions() == 8
    assert sorted(r.id for r in spread(one, 8).collect()) == list(range(1000))


def test_checkpoint_dir_comes_from_the_session(spark):
    path = ensure_checkpoint_dir(spark)
    assert path and spark.conf.get("spark.checkpoint.dir") == path
