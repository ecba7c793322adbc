import ipaddress

import pytest
from pyspark.sql import functions as F

from netsift.functions import ipaddr

V6_CASES = [
    "fddd:be2e:c6ba::5", "2001:db8::1", "::1", "::", "1:2:3:4:5:6:7:8", "2001:0db8:0000:0000:0001:0000:0000:0001",
    "1:0:0:1:0:0:0:1", "FDDD:BE2E:C6BA::FFF", "fe80::1%eth0", "::ffff:10.1.2.3", "2001:db8:0:0:1::1", "1::",
]
V4_CASES = ["0.0.0.0", "10.10.5.7", " 10.10.5.7 ", "255.255.255.255", "192.168.10.0", "\t1.2.3.4\n"]
BAD = ["", "bad", "1::2::3", "256.1.1.1", "010.1.1.1", "1.2.3", "12345::", "10.10.5.7.1"]


def _rows(spark, values, *cols):
    df = spark.createDataFrame([(v,) for v in values], "ip string")
    return df.select("ip", *cols).collect()


def test_v6_matches_ipaddress(spark):
    rows = _rows(spark, V6_CASES, ipaddr.ip_family("ip").alias("fam"), ipaddr.ip_key("ip").alias("key"))
    for r in rows:
        a = ipaddress.ip_address(r.ip.strip().split("%")[0])
        assert r.fam == 6, r.ip
        assert r.key == f"{int(a):032x}", r.ip


def test_v6_short_form_matches_ipaddress(spark):
    df = spark.createDataFrame([(v,) for v in V6_CASES if "." not in v], "ip string")
    rows = df.select("ip", ipaddr.ip_key("ip").alias("key")).select("ip", ipaddr.hex_to_v6("key").alias("short")).collect()
    for r in rows:
        assert r.short == ipaddress.ip_address(r.ip.strip().split("%")[0]).compressed


def test_v4_matches_ipaddress(spark):
    rows = _rows(spark, V4_CASES, ipaddr.ip_family("ip").alias("fam"), ipaddr.v4_to_long("ip").alias("n"))
    for r in rows:
        assert r.fam == 4
        assert r.n == int(ipaddress.ip_address(r.ip.strip()))


def test_not_addresses(spark):
    rows = _rows(spark, BAD, ipaddr.ip_family("ip").alias("fam"), ipaddr.ip_key("ip").alias("key"))
    for r in rows:
        assert r.fam is None and r.key is None, r.ip


def test_java_trim_strips_control_characters(spark):
    df = spark.createDataFrame([("\x00\t a b \r\n\x1f",)], "s string")
    assert df.select(ipaddr.java_trim("s").alias("t")).first().t == "a b"


def test_long_to_v4_round_trip(spark):
    df = spark.createDataFrame([(x,) for x in V4_CASES], "ip string")
    out = df.select("ip", ipaddr.v4_to_long("ip").alias("n")).select("ip", F.expr(ipaddr.long_to_v4_sql("n")).alias("back"))
    for r in out.collect():
        assert r.back == r.ip.strip()
