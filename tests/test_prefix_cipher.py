import ipaddress
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from netsift.functions import cryptopan as cp
from netsift.operators import anonymize as anon
from netsift.operators import prefix_cipher as pc
from netsift.plans.common import SAMPLE_KEY

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _addresses():
    rng = random.Random(3)
    out = [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(40)]
    out += [f"10.1.{i % 3}.{i}" for i in range(60)] + ["0.0.0.0", "255.255.255.255"]
    net = rng.getrandbits(64) << 64
    out += [str(ipaddress.IPv6Address(net | rng.getrandbits(20))) for _ in range(60)]
    out += [str(ipaddress.IPv6Address(rng.getrandbits(128))) for _ in range(20)]
    # an IPv6 network that begins with the bits of an IPv4 address, two texts of one address, no addresses
    return out + ["a01:105::1", "10.1.1.5", "::", "::1", "0:0:0:0:0:0:0:1", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "no address", "", None]


def _prefixes(texts):
    found = set()
    for t in texts:
        try:
            a = ipaddress.ip_address(t or "")
        except ValueError:
            continue
        b = f"{int(a):0{a.max_prefixlen}b}"
        found |= {b[:i] for i in range(len(b))}
    return found


@pytest.mark.parametrize("file", [False, True])
def test_equals_address_by_address(spark, tmp_path, file):
    ips = sorted(set(_addresses()), key=str)
    df = spark.createDataFrame([(x, i) for i, x in enumerate(ips)], "original_ip string, n_cells long")
    key = cp.write_key_file(spark, str(tmp_path / "key"), SAMPLE_KEY) if file else SAMPLE_KEY
    want = {r.original_ip: r.obfuscated_ip for r in anon.build_mapping(df, SAMPLE_KEY).collect()}
    got = pc.build_mapping_by_prefixes(df, key)
    assert got.columns == ["original_ip", "obfuscated_ip", "n_cells"]
    rows = got.collect()
    assert len(rows) == len(ips) and {r.original_ip: r.obfuscated_ip for r in rows} == want
    assert {r.original_ip: r.n_cells for r in rows} == {x: i for i, x in enumerate(ips)}


def test_one_call_for_each_distinct_prefix(spark):
    ips = _addresses()
    df = spark.createDataFrame([(x,) for x in ips], "ip string")
    calls = pc.encrypted_words(pc.words(pc.keyed(df, "ip")), SAMPLE_KEY).agg(F.sum("n_calls")).first()[0]
    assert calls == len(_prefixes(ips))


def test_empty_table(spark):
    assert pc.build_mapping_by_prefixes(spark.createDataFrame([], "original_ip string"), SAMPLE_KEY).collect() == []


def test_key_file_in_every_form(spark, tmp_path):
    key = cp.write_key_file(spark, str(tmp_path / "key"), SAMPLE_KEY)
    df = spark.createDataFrame([("128.11.68.132",), ("2001:db8::5",), ("no address",)], "original_ip string")
    there = anon.build_mapping(df, key)
    assert {r.original_ip: r.obfuscated_ip for r in there.collect()} == {
        r.original_ip: r.obfuscated_ip for r in anon.build_mapping(df, SAMPLE_KEY).collect()}
    back = anon.inverse_mapping(there.filter("obfuscated_ip is not null").select("obfuscated_ip"), key)
    assert {r.original_ip for r in back.collect()} == {"128.11.68.132", "2001:db8::5"}
    short = str(tmp_path / "short")
    (tmp_path / "short").write_bytes(b"x" * 31)
    with pytest.raises(Exception, match="32 bytes"):
        anon.build_mapping(df, cp.KeyFile(short)).collect()
    from netsift.operators.policy import read_policy

    policy = read_policy(spark, lines=["128.11.68.0/24"])
    inline = anon.apply_mapping(df, ["original_ip"], policy=policy, key=key, strategy="inline")
    assert inline.columns == ["original_ip"]
    assert sorted(r.original_ip for r in inline.collect()) == ["135.242.180.132", "2001:db8::5", "no address"]
    from netsift.operators.mapping_store import MappingStore

    named = df.filter("original_ip <> 'no address'").withColumn("family", F.lit(4))
    MappingStore(spark, str(tmp_path / "store"), key).add(named, "b")
    assert {r.obfuscated_ip for r in MappingStore(spark, str(tmp_path / "store"), SAMPLE_KEY).read().collect()} >= {"135.242.180.132"}


_JOB = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", sys.argv[2]).config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
from netsift.functions.cryptopan import KeyFile
from netsift.operators import anonymize, prefix_cipher
path, plain = sys.argv[3], sys.argv[4] == "plain"
key = open(path, "rb").read() if plain else KeyFile(path)
df = spark.createDataFrame([("128.11.68.132",), ("2001:db8::5",)], "original_ip string")
for build in (anonymize.build_mapping, prefix_cipher.build_mapping_by_prefixes):
    m = build(df, key)
    assert m.filter("obfuscated_ip = '135.242.180.132'").count() == 1
    m.collect()
    for mode in ("extended", "formatted", "codegen"):
        m.explain(mode)
back = anonymize.inverse_mapping(m.select("obfuscated_ip"), key)
back.collect()
back.explain("extended")
spark.stop()
"""


def _traces(text: str, key: bytes, pad: str) -> list[str]:
    """What of the key stands in the text: its halves and the encrypted pad as hex, the pad's words as numbers."""
    low = text.lower()
    names = [key[:16].hex(), key[16:].hex(), pad, *(str(int(pad[i: i + 8], 16)) for i in range(0, 32, 8))]
    return [n for n in names if n in low]


@pytest.mark.parametrize("form", ["file", "plain"])
def test_no_plan_or_event_log_holds_the_key(spark, tmp_path, form):
    log = tmp_path / "log"
    log.mkdir()
    key = cp.write_key_file(spark, str(tmp_path / "key"), SAMPLE_KEY)
    pad = "".join(f"{w:08x}" for w in cp._pad_words_of(SAMPLE_KEY))
    done = subprocess.run([sys.executable, "-c", _JOB, ROOT, str(log), key.path, form], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert done.returncode == 0, done.stderr[-2000:]
    events = "".join(p.read_text() for p in log.rglob("*") if p.is_file() and not p.name.endswith(".crc"))
    assert "physicalPlanDescription" in events and "aesencrypt" in events.lower()
    # with the key's bytes the same search does find it
    assert bool(_traces(done.stdout + events, SAMPLE_KEY, pad)) == (form == "plain")
