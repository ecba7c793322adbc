import pytest
from pyspark.sql import functions as F

from netsift.operators import policy as pol
from netsift.plans.common import POLICY


def _intervals(policy):
    return sorted((r.family, r.lo, r.hi) for r in policy.intervals.collect())


def test_shipped_policy_intervals(spark):
    p = pol.read_policy(spark, lines=POLICY)
    v4 = [(int(lo, 16), int(hi, 16)) for fam, lo, hi in _intervals(p) if fam == 4]
    assert v4 == [(168428801, 168429054), (168430337, 168430590), (3232238081, 3232238334)]
    v6 = [(lo, hi) for fam, lo, hi in _intervals(p) if fam == 6]
    assert v6 == [("fdddbe2ec6ba00000000000000000000", "fdddbe2ec6ba00000000000000000fff")]


def test_rule_forms(spark):
    cases = {
        "192.168.1.50,192.168.1.75": (4, "c0a80132", "c0a8014b"),
        "192.168.1.75,192.168.1.50": (4, "c0a80132", "c0a8014b"),
        "192.168.1.50": (4, "c0a80132", "c0a80132"),
        "2001:db8::1,2001:db8::ff": (6, "20010db8000000000000000000000001", "20010db80000000000000000000000ff"),
        "2001:DB8::5": (6, "20010db8000000000000000000000005", "20010db8000000000000000000000005"),
    }
    for rule, expected in cases.items():
        assert _intervals(pol.read_policy(spark, lines=[rule])) == [expected], rule


def test_host_only_edges_and_empty_subnets(spark):
    assert _intervals(pol.read_policy(spark, lines=["1.2.3.4/31", "1.2.3.4/32"])) == []
    p = pol.read_policy(spark, lines=["10.0.0.0/30"], include_edges=True)
    assert _intervals(p) == [(4, "0a000000", "0a000003")]


def test_blank_lines_ignored_and_bad_rules_raise(spark):
    assert len(_intervals(pol.read_policy(spark, lines=["", "  ", "10.1.1.1"]))) == 1
    with pytest.raises(ValueError):
        pol.read_policy(spark, lines=["not-an-address"])


def test_default_policy(spark):
    p = pol.read_policy(spark, default=True)
    assert _intervals(p) == [(4, "0a001300", "0a0013fe"), (4, "c0a80100", "c0a801fe")]


def test_overlaps_merge(spark):
    p = pol.read_policy(spark, lines=["10.0.0.0,10.0.0.50", "10.0.0.40,10.0.0.90", "10.0.0.95", "10.0.0.60,10.0.0.70"])
    assert _intervals(p) == [(4, "0a000000", "0a00005a"), (4, "0a00005f", "0a00005f")]


def test_three_plans_agree_and_keep_rows(spark):
    from netsift.plans.anonymize_queries import ANY_POLICY
    from netsift.plans.common import parsed_flows

    flows = parsed_flows(spark, "/root/testdata/sf0.001").select("k", "sa", "da")
    n = flows.count()
    p = pol.read_policy(spark, lines=ANY_POLICY)
    results = []
    for plan in ("or", "bucket", "range"):
        out = pol.match_policy(pol.match_policy(flows, "sa", p, plan=plan), "da", p, plan=plan)
        rows = sorted(out.select("k", "sa_sensitive", "da_sensitive").collect())
        assert len(rows) == n
        results.append(rows)
    assert results[0] == results[1] == results[2]
    assert any(r.sa_sensitive for r in results[0]) and not all(r.sa_sensitive for r in results[0])


def test_bucket_table_over_the_broadcast_limit_is_shuffled(spark):
    from netsift.plans.anonymize_queries import ANY_POLICY
    from netsift.plans.common import parsed_flows

    flows = parsed_flows(spark, "/root/testdata/sf0.001").select("k", "da")
    p = pol.read_policy(spark, lines=ANY_POLICY)
    small = pol.match_policy(flows, "da", p, plan="bucket")
    large = pol.match_policy(flows, "da", p, plan="bucket", max_broadcast_rows=0)
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    assert sorted(small.collect()) == sorted(large.collect())


def test_policy_from_a_file(spark, tmp_path):
    path = tmp_path / "policy.txt"
    path.write_text("\n".join([*POLICY, "", "  10.1.1.1  "]))
    assert _intervals(pol.read_policy(spark, str(path))) == _intervals(pol.read_policy(spark, lines=[*POLICY, "10.1.1.1"]))
    with pytest.raises(Exception):
        pol.read_policy(spark, str(tmp_path / "missing.txt"))


def test_bucket_plan_is_a_broadcast_hash_join(spark):
    flows = spark.createDataFrame([("10.10.5.9",)], "sa string")
    p = pol.read_policy(spark, lines=POLICY)
    plan = pol.match_policy(flows, "sa", p, plan="bucket")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert F  # keep import used


def test_large_policy_path_is_checkpointed_and_bucketed(spark):
    rules = [f"10.{i}.0.0/24" for i in range(12)] + ["2001:db8::/120"]
    small = pol.read_policy(spark, lines=rules)
    large = pol.read_policy(spark, lines=rules, max_or_intervals=3)
    assert large.rows is None and large.n == small.n == 13
    cells = spark.createDataFrame([("10.3.0.7",), ("10.3.1.7",), ("2001:db8::ff",), ("2001:db8::1:0",), ("x",)], "ip string")
    got = {r.ip: r.ip_sensitive for r in pol.match_policy(cells, "ip", large).collect()}
    assert got == {"10.3.0.7": True, "10.3.1.7": False, "2001:db8::ff": True, "2001:db8::1:0": False, "x": False}


def _random_rules(n, seed):
    """Ranges of all widths, and addresses, of both families."""
    import ipaddress
    import random

    rng, out = random.Random(seed), []
    for _ in range(n):
        cls, bits = (ipaddress.IPv4Address, 32) if rng.random() < 0.5 else (ipaddress.IPv6Address, 128)
        a = rng.getrandbits(bits)
        b = min(a + rng.getrandbits(rng.randrange(1, bits - 6)), 2**bits - 1)
        out.append((cls(a), cls(b)))
    return out


def test_least_prefixes(spark):
    import ipaddress

    from netsift.functions import ipaddr
    from netsift.operators.prefixes import digit_table, prefix_table

    rules = _random_rules(300, 1)
    for v in (ipaddress.IPv4Address, ipaddress.IPv6Address):
        top = 2 ** v("::" if v is ipaddress.IPv6Address else "0.0.0.0").max_prefixlen - 1
        rules += [(v(0), v(top)), (v(1), v(top - 1)), (v(0), v(0)), (v(top), v(top)), (v(0), v(top // 2)), (v(5), v(6)), (v(top // 2), v(top // 2 + 1)), (v(4), v(7))]
    rows = [(a.version, f"{int(a):0{a.max_prefixlen // 4}x}", f"{int(b):0{a.max_prefixlen // 4}x}") for a, b in rules]
    table = prefix_table(spark.createDataFrame(rows, "family int, lo string, hi string"))
    got = sorted((r.family, r.bits) for r in table.collect())
    want = []
    for a, b in rules:
        nets = list(ipaddress.summarize_address_range(a, b))
        assert len(nets) <= (62 if a.version == 4 else 254)
        want += [(a.version, f"{int(n.network_address):0{a.max_prefixlen}b}"[: n.prefixlen]) for n in nets]
    assert got == sorted(want)
    longer = digit_table(spark.createDataFrame([(4, ""), (4, "0000101"), (6, "1" * 9), (4, "1010")], "family int, bits string"))
    assert sorted((r.digits, r.prefix) for r in longer.collect()) == [(0, ""), (1, "a"), (2, "0a"), (2, "0b")] + [(3, f"ff{d:x}") for d in range(8, 16)]
    assert ipaddr.V4 == 4


def test_many_wide_rules_by_prefixes(spark):
    """Rules of all widths, more wide ones than an OR may have: broadcast and shuffled joins agree with the intervals themselves."""
    import bisect
    import ipaddress
    import random

    rng = random.Random(2)
    lines = []
    for _ in range(4_000):  # narrow and wide, in a half of the space, so that some addresses are outside
        a = rng.getrandbits(31)
        lines.append((a, min(a + rng.getrandbits(rng.randrange(1, 15)), 2**31)))
    wide = [(2**31 + i * 2**22, 2**31 + i * 2**22 + 2**21 + rng.getrandbits(20)) for i in range(400)]
    v6 = [(x << 90, (x << 90) + rng.getrandbits(rng.randrange(1, 89))) for x in rng.sample(range(2**30), 3_300)]
    v6 += [(2**127 + (i << 110), 2**127 + (i << 110) + 2**105 + rng.getrandbits(100)) for i in range(300)]
    text = [f"{ipaddress.IPv4Address(a)},{ipaddress.IPv4Address(b)}" for a, b in lines + wide]
    text += [f"{ipaddress.IPv6Address(a)},{ipaddress.IPv6Address(b)}" for a, b in v6]
    assert len(text) == 8_000
    rules = spark.createDataFrame([(x,) for x in text], "value string")
    merged = pol._checkpointed(pol.merge_intervals(pol.compile_rules(rules)))
    p = pol.Policy(merged, merged.count(), None)
    assert p.wide is None
    ends = {4: sorted(lines + wide), 6: sorted(v6)}
    cells = [rng.choice([rng.getrandbits(32), (x := rng.choice(lines + wide))[rng.randrange(2)] + rng.randrange(-2, 3)]) % 2**32 for _ in range(1500)]
    cells6 = [(x := rng.choice(v6))[rng.randrange(2)] + rng.randrange(-2, 3) for _ in range(1000)]
    every = [(4, c) for c in cells] + [(6, c % 2**128) for c in cells6]
    spans = {}
    for f, pairs in ends.items():
        merged_pairs = []
        for a, b in pairs:
            if merged_pairs and a <= merged_pairs[-1][1]:
                merged_pairs[-1][1] = max(merged_pairs[-1][1], b)
            else:
                merged_pairs.append([a, b])
        spans[f] = merged_pairs

    def inside(f, c):
        i = bisect.bisect_right(spans[f], [c, 2**130]) - 1
        return i >= 0 and spans[f][i][0] <= c <= spans[f][i][1]

    rows = [(i, str(ipaddress.IPv4Address(c) if f == 4 else ipaddress.IPv6Address(c)), inside(f, c)) for i, (f, c) in enumerate(every)]
    rows += [(-1, None, False), (-2, " x ", False)]
    assert 250 < sum(r[2] for r in rows) < 2450
    df = spark.createDataFrame(rows, "i int, ip string, want boolean")
    for limits in ({"max_broadcast_rows": 10**7}, {"max_broadcast_rows": 1}):
        got = pol.match_policy(df, "ip", p, plan="bucket", **limits)
        assert got.columns == ["i", "ip", "want", "ip_sensitive"] and got.count() == len(rows)
        assert got.filter("want <> ip_sensitive").count() == 0
    plan = pol.match_policy(df, "ip", p, plan="prefix")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join " in line]
    assert joins and not any(">" in j or "<" in j for j in joins)  # equality alone


def test_prefix_plan_agrees_with_or(spark):
    from netsift.plans.anonymize_queries import ANY_POLICY
    from netsift.plans.common import parsed_flows

    flows = parsed_flows(spark, "/root/testdata/sf0.001").select("k", "sa", "da")
    p = pol.read_policy(spark, lines=[*ANY_POLICY, "0.0.0.0,9.255.255.255", "::,2000::"])
    for c in ("sa", "da"):
        either = [sorted(map(tuple, pol.match_policy(flows, c, p, plan=plan).collect())) for plan in ("or", "prefix")]
        assert either[0] == either[1]
