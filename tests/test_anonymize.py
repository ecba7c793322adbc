import pytest
from pyspark.sql import functions as F

from netsift.operators import anonymize as anon
from netsift.operators import policy as pol
from netsift.plans.common import POLICY, SAMPLE_KEY


@pytest.fixture()
def flows(spark):
    rows = [(1, " 10.10.5.7 ", "8.8.8.8"), (2, "10.10.5.7", "fddd:be2e:c6ba::1"), (3, "1.1.1.1", "10.10.11.254"),
            (4, "10.10.5.0", "2001:db8::1"), (5, "10.10.5.7", "10.10.5.7")]
    return spark.createDataFrame(rows, "k long, sa string, da string")


@pytest.fixture()
def policy(spark):
    return pol.read_policy(spark, lines=POLICY)


def test_sensitive_ips_counts(flows, policy):
    got = {r.original_ip: (r.family, r.n_cells) for r in anon.sensitive_ips(flows, ["sa", "da"], policy).collect()}
    assert got == {"10.10.5.7": (4, 4), "fddd:be2e:c6ba::1": (6, 1), "10.10.11.254": (4, 1)}


def test_apply_mapping_replaces_only_sensitive_cells(flows, policy):
    mapping = anon.build_mapping(anon.sensitive_ips(flows, ["sa", "da"], policy), SAMPLE_KEY)
    m = {r.original_ip: r.obfuscated_ip for r in mapping.collect()}
    out = {r.k: (r.sa, r.da) for r in anon.apply_mapping(flows, ["sa", "da"], mapping, policy=policy).collect()}
    assert out[1] == (m["10.10.5.7"], "8.8.8.8")
    assert out[2] == (m["10.10.5.7"], m["fddd:be2e:c6ba::1"])
    assert out[3] == ("1.1.1.1", m["10.10.11.254"])
    assert out[4] == ("10.10.5.0", "2001:db8::1")  # network address is not a host address


def test_inline_equals_mapping_join(flows, policy):
    mapping = anon.build_mapping(anon.sensitive_ips(flows, ["sa", "da"], policy), SAMPLE_KEY)
    a = sorted(anon.apply_mapping(flows, ["sa", "da"], mapping, policy=policy).collect())
    b = sorted(anon.apply_mapping(flows, ["sa", "da"], None, policy=policy, key=SAMPLE_KEY, strategy="inline").collect())
    assert a == b


def test_unmapped_sensitive_cell_never_in_clear(spark, flows, policy):
    partial = spark.createDataFrame([("10.10.5.7", "x")], "original_ip string, obfuscated_ip string")
    out = {r.k: r.da for r in anon.apply_mapping(flows, ["sa", "da"], partial, policy=policy).collect()}
    assert out[3] is None and out[2] is None and out[1] == "8.8.8.8"
    with pytest.raises(Exception):
        anon.apply_mapping(flows, ["sa", "da"], partial, policy=policy, strict=True).collect()


def test_deanonymize_is_inverse(flows, policy):
    mapping = anon.materialize(anon.build_mapping(anon.sensitive_ips(flows, ["sa", "da"], policy), SAMPLE_KEY))
    masked = anon.apply_mapping(flows, ["sa", "da"], mapping, policy=policy)
    back = anon.deanonymize(masked, ["sa", "da"], mapping)
    expected = flows.select("k", F.trim("sa").alias("sa"), "da")
    assert sorted(back.collect()) == sorted(expected.collect())


def test_broadcast_limit_is_checked(flows, policy):
    mapping = anon.build_mapping(anon.sensitive_ips(flows, ["sa", "da"], policy), SAMPLE_KEY)
    with pytest.raises(ValueError):
        anon.apply_mapping(flows, ["sa", "da"], mapping, strategy="broadcast", max_broadcast_rows=1)
    # over the limit without a key: a shuffle join, same result
    a = sorted(anon.apply_mapping(flows, ["sa", "da"], mapping, max_broadcast_rows=1).collect())
    b = sorted(anon.apply_mapping(flows, ["sa", "da"], mapping).collect())
    assert a == b


def test_audit_rows(flows, policy):
    mapping = anon.build_mapping(anon.sensitive_ips(flows, ["sa", "da"], policy), SAMPLE_KEY)
    rows = anon.audit(mapping).collect()
    assert {r.result for r in rows} == {"anonymized"} and sum(r.n_cells for r in rows) == 6


def test_result_does_not_depend_on_the_size_of_the_mapping(spark, flows, policy):
    partial = spark.createDataFrame([("10.10.5.7", "x")], "original_ip string, obfuscated_ip string")
    a = sorted(anon.apply_mapping(flows, ["sa", "da"], partial, policy=policy, key=SAMPLE_KEY).collect(), key=str)
    b = sorted(anon.apply_mapping(flows, ["sa", "da"], partial, policy=policy, key=SAMPLE_KEY, max_broadcast_rows=0).collect(), key=str)
    assert a == b
    with pytest.raises(Exception):
        anon.apply_mapping(flows, ["sa", "da"], partial, policy=policy, key=SAMPLE_KEY, strict=True, max_broadcast_rows=0).collect()


def test_clear_cell_that_equals_a_pseudonym_stays(spark, flows, policy):
    mapping = spark.createDataFrame(
        [("10.10.5.7", "8.8.8.8"), ("fddd:be2e:c6ba::1", "2001:db8::1"), ("10.10.11.254", "1.1.1.1")], "original_ip string, obfuscated_ip string"
    )
    masked = anon.apply_mapping(flows, ["sa", "da"], mapping, policy=policy, flag=True)
    back = anon.deanonymize(masked, ["sa", "da"], mapping).select("k", "sa", "da")
    assert sorted(back.collect()) == sorted(flows.select("k", F.trim("sa").alias("sa"), "da").collect())


def _flows(spark, cells):
    return spark.createDataFrame(cells, "k bigint, sa string, da string")


CELLS = [(1, "10.10.5.7", "fddd:be2e:c6ba::0"), (2, " 10.10.5.7 ", "8.8.8.8"), (3, None, "FDDD:be2e:c6ba::1"), (4, "10.10.5.0", "no address"), (5, "10.10.5.7", "")]


def test_policy_is_asked_once_an_address(spark):
    policy = pol.read_policy(spark, lines=("10.10.5.0/24", "fddd:be2e:c6ba::/116"))
    ips = anon.sensitive_ips(_flows(spark, CELLS), ["sa", "da"], policy)
    plan = ips._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan and "RLIKE" not in plan.split("Aggregate", 1)[1]
    assert {(r.original_ip, r.n_cells) for r in ips.collect()} == {("10.10.5.7", 3), ("fddd:be2e:c6ba::0", 1), ("FDDD:be2e:c6ba::1", 1)}


def test_only_distinct_pseudonyms_are_decrypted(spark, monkeypatch):
    policy = pol.read_policy(spark, lines=("10.10.5.0/24", "fddd:be2e:c6ba::/116"))
    df, seen, inverse = _flows(spark, CELLS), [], anon.inverse_mapping

    def watched(pseudonyms, key, *args):
        seen.append(pseudonyms._jdf.queryExecution().optimizedPlan().toString())
        return inverse(pseudonyms, key, *args)

    monkeypatch.setattr(anon, "inverse_mapping", watched)
    for flag in (True, False):
        mapping = anon.materialize(anon.build_mapping(anon.sensitive_ips(df, ["sa", "da"], policy), SAMPLE_KEY))
        hidden = anon.apply_mapping(df, ["sa", "da"], mapping, unique=True, flag=flag)
        back = anon.deanonymize_by_key(hidden, ["sa", "da"], key=SAMPLE_KEY, policy=None if flag else policy)
        got = {r.k: (r.sa, r.da) for r in back.collect()}
        assert got == {1: ("10.10.5.7", "fddd:be2e:c6ba::"), 2: ("10.10.5.7", "8.8.8.8"), 3: (None, "fddd:be2e:c6ba::1"),
                       4: ("10.10.5.0", "no address"), 5: ("10.10.5.7", "")}
    assert len(seen) == 2 and not any("Aggregate" in plan for plan in seen)  # written rows: no filter can pass below the distinct step


def test_mapping_of_a_whole_policy(spark):
    policy = pol.read_policy(spark, lines=("10.10.5.4/30", "10.10.6.9", "fddd:be2e:c6ba::fffe,fddd:be2e:c6ba::1:1"))
    mapping = anon.policy_mapping(policy, SAMPLE_KEY)
    assert mapping.count() == 2 + 1 + 4 and mapping.filter("obfuscated_ip is null").count() == 0
    cells = [(i, a, b) for i, (a, b) in enumerate([
        ("10.10.5.4", "fddd:be2e:c6ba::fffe"), (" 10.10.5.5", "FDDD:be2e:c6ba:0::ffff "), ("10.10.5.6", "fddd:be2e:c6ba::1:1"),
        ("10.10.5.7", "fddd:be2e:c6ba::1:2"), ("10.10.6.9", None), (None, ""), ("10.10.6.10", "x")])]
    df = _flows(spark, cells)
    want = anon.apply_mapping(df, ["sa", "da"], None, policy=policy, key=SAMPLE_KEY, strategy="inline")
    got = anon.apply_policy_mapping(df, ["sa", "da"], mapping)
    assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert anon.policy_mapping(policy, SAMPLE_KEY, limit=6) is None
    wide = pol.read_policy(spark, lines=("2001:db8::/32",))
    assert anon.policy_mapping(wide, SAMPLE_KEY) is None
