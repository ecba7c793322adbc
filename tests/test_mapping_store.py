import pytest

from netsift.operators import anonymize as anon
from netsift.operators.mapping_store import MappingStore
from netsift.plans.common import SAMPLE_KEY


def _ips(spark, *ips):
    return spark.createDataFrame([(x, 6 if ":" in x else 4, 1) for x in ips], "original_ip string, family int, n_cells long")


def test_only_new_addresses_reach_the_cipher(spark, tmp_path, monkeypatch):
    store = MappingStore(spark, str(tmp_path), SAMPLE_KEY, n_buckets=3)
    met = []
    build = anon.build_mapping

    def counted(ips, key):
        met.append(sorted(r.original_ip for r in ips.collect()))
        return build(ips, key)

    monkeypatch.setattr(anon, "build_mapping", counted)
    first = store.add(_ips(spark, "10.0.0.1", "10.0.0.2", "2001:db8::1"), "r-0")
    store.add(_ips(spark, "10.0.0.2", "10.0.0.3"), "r-1")
    again = store.add(_ips(spark, "10.0.0.2", "10.0.0.3"), "r-1")
    assert met == [["10.0.0.1", "10.0.0.2", "2001:db8::1"], ["10.0.0.3"]]
    want = {r.original_ip: r.obfuscated_ip for r in build(_ips(spark, "10.0.0.1", "10.0.0.2", "10.0.0.3", "2001:db8::1"), SAMPLE_KEY).collect()}
    assert {r.original_ip: r.obfuscated_ip for r in first.collect()} == {k: want[k] for k in ("10.0.0.1", "10.0.0.2", "2001:db8::1")}
    assert sorted((r.original_ip, r.obfuscated_ip, r.n_cells) for r in again.collect()) == [(k, want[k], 1) for k in ("10.0.0.2", "10.0.0.3")]
    plan = build(store.pending(_ips(spark, "10.0.0.3", "10.0.0.9")), SAMPLE_KEY)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("aesEncrypt") < plan.index("LeftAnti")  # the cipher stands above the anti-join
    # another run, another reader, a compaction, and empty batches
    other = MappingStore(spark, str(tmp_path), SAMPLE_KEY)
    other.compact()
    other.add(_ips(spark, "10.0.0.1", "10.0.0.4"), "s-0")
    other.add(_ips(spark).limit(0), "s-1")
    other.add(_ips(spark, "10.0.0.2", "10.0.0.3"), "r-1")
    assert met[2:] == [["10.0.0.4"], []]
    rows = {r.original_ip: r.first_batch for r in store.read().collect()}
    assert rows == {"10.0.0.1": "r-0", "10.0.0.2": "r-0", "2001:db8::1": "r-0", "10.0.0.3": "r-1", "10.0.0.4": "s-0"}


def test_uncommitted_attempts_are_not_read(spark, tmp_path, monkeypatch):
    store = MappingStore(spark, str(tmp_path), SAMPLE_KEY)
    write = type(spark.range(1).write).json

    def fail(self, *a, **b):
        raise OSError("no space")

    monkeypatch.setattr(type(spark.range(1).write), "json", fail)
    with pytest.raises(OSError):
        store.add(_ips(spark, "10.0.0.1"), "r-0")
    monkeypatch.setattr(type(spark.range(1).write), "json", write)
    assert store.read().count() == 0 and not store.has("r-0")
    store.add(_ips(spark, "10.0.0.1"), "r-0")
    assert store.read().count() == 1
    with pytest.raises(ValueError, match="another key"):
        MappingStore(spark, str(tmp_path), bytes(range(32)))
