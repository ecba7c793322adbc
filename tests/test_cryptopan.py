import ipaddress
import random

from pyspark.sql import functions as F

from netsift.functions import cryptopan as cp
from netsift.plans.common import SAMPLE_KEY

# Published sample pairs of the Crypto-PAn reference distribution (sample key).
KNOWN = {
    "128.11.68.132": "135.242.180.132",
    "129.118.74.4": "134.136.186.123",
    "130.132.252.244": "133.68.164.234",
}


def _map(spark, ips):
    df = spark.createDataFrame([(x,) for x in ips], "ip string")
    return {r.ip: r.p for r in df.select("ip", cp.cryptopan("ip", SAMPLE_KEY).alias("p")).collect()}


def _common_prefix(a: int, b: int, bits: int) -> int:
    x = a ^ b
    return bits if x == 0 else bits - x.bit_length()


def test_known_answers(spark):
    assert _map(spark, list(KNOWN)) == KNOWN


def test_v4_prefix_preserving_and_injective(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(32) for _ in range(40)]
    # include close neighbours so that long shared prefixes occur
    ips = sorted({str(ipaddress.IPv4Address(x)) for b in base for x in (b, b ^ 1, b ^ 0x100, b ^ 0x10000)})
    m = _map(spark, ips)
    assert len(set(m.values())) == len(ips)
    nums = {ip: int(ipaddress.IPv4Address(ip)) for ip in ips}
    outs = {ip: int(ipaddress.IPv4Address(m[ip])) for ip in ips}
    for a in ips[:60]:
        for b in ips[:60]:
            assert _common_prefix(nums[a], nums[b], 32) == _common_prefix(outs[a], outs[b], 32)


def test_v6_prefix_preserving(spark):
    ips = ["2001:db8::1", "2001:db8::2", "2001:db8:0:1::1", "fddd:be2e:c6ba::5", "fddd:be2e:c6ba::fff", "::1", "::"]
    m = _map(spark, ips)
    for a in ips:
        for b in ips:
            na, nb = int(ipaddress.IPv6Address(a)), int(ipaddress.IPv6Address(b))
            oa, ob = int(ipaddress.IPv6Address(m[a])), int(ipaddress.IPv6Address(m[b]))
            assert _common_prefix(na, nb, 128) == _common_prefix(oa, ob, 128)


def test_not_an_address_gives_null(spark):
    assert _map(spark, ["x", ""]) == {"x": None, "": None}


def test_key_must_be_32_bytes():
    import pytest

    with pytest.raises(ValueError):
        cp.cryptopan_sql("ip", b"short")
    assert F  # keep import used


def test_inverse_gives_known_answers_back(spark):
    import random
    import ipaddress

    rng = random.Random(5)
    rows = [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(60)] + ["0.0.0.0", "255.255.255.255"]
    rows += [str(ipaddress.IPv6Address(rng.getrandbits(128))) for _ in range(25)] + ["::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "::1"]
    df = spark.createDataFrame([(r,) for r in [*rows, "no address", None]], "ip string")
    there = df.withColumn("p", cp.cryptopan("ip", SAMPLE_KEY))
    back = there.withColumn("q", cp.cryptopan_inverse("p", SAMPLE_KEY)).collect()
    assert {r.ip: r.q for r in back} == {**{r: r for r in rows}, "no address": None, None: None}
    first = cp.cryptopan_inverse("ip", SAMPLE_KEY)
    known = spark.createDataFrame([("135.242.180.132",), ("134.136.186.123",)], "ip string").select(first.alias("o"))
    assert [r.o for r in known.collect()] == ["128.11.68.132", "129.118.74.4"]


def test_one_cipher_call_for_each_word():
    text = cp.cryptopan_sql("ip", bytes(range(32)))
    assert text.count("aes_encrypt") == 5  # one for IPv4, four for IPv6
