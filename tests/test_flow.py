import pytest
from pyspark.sql import functions as F

from netsift import schemas
from netsift.operators import features as feat
from netsift.operators import flow as flowop

Z = ",".join(["0"] * 33)
GOLDEN = {
    "G1": f"2021-11-03 10:00:00,2021-11-03 10:00:05,5.000,192.168.10.5,8.8.8.8,51000,53,UDP,......,0,0,2,120,2,340,{Z}",
    "G2": f"2021-11-03 10:00:01,2021-11-03 10:00:09,8.000,10.10.5.0,10.10.11.254,40000,8080,TCP,X,0,0,1,9999999,0,1,{Z}",
    "G3": f"2021-11-03 10:00:02,2021-11-03 10:00:02,0.000, 10.10.5.7 ,fddd:be2e:c6ba::1, 443 , 443 , tcp ,.aP.SF,0,0, 3 , 180 , 0 , 0 ,{Z}",
    "G4": f"2021-11-03 10:00:03,2021-11-03 10:00:03,0.000,2001:db8::1,192.168.10.255,0,0,GRE,,0,0,1,64,0,0,{Z}",
    "G5": f"2021-11-03 10:00:04,2021-11-03 10:00:04,0.000,10.10.11.1,1.1.1.1,5,8.0,ICMP,......,0,0,1,64,0,0,{Z}",
}
EXPECTED = {  # tpkt, tbyt text, cp, tcp udp icmp igmp other, a s f r p u
    "G1": (4, "460.0", 1, (0, 1, 0, 0, 0), (0, 0, 0, 0, 0, 0)),
    "G2": (1, "1.0E7", 0, (1, 0, 0, 0, 0), (1, 1, 1, 1, 1, 1)),
    "G3": (3, "180.0", 1, (1, 0, 0, 0, 0), (1, 1, 1, 0, 1, 0)),
    "G4": (1, "64.0", 0, (0, 0, 0, 0, 1), (0, 0, 0, 0, 0, 0)),
}


@pytest.fixture()
def golden(spark):
    rows = [(k.encode(), v.encode(), "t", 0, i) for i, (k, v) in enumerate(GOLDEN.items())]
    env = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint")
    return flowop.parse_flow(env)


def test_golden_features(golden):
    out = feat.add_features(flowop.good_rows(golden))
    got = {r.key.decode(): r for r in out.collect()}
    assert set(got) == {"G1", "G2", "G3", "G4"}
    for name, (tpkt, tbyt, cp, protos, flags) in EXPECTED.items():
        r = got[name]
        assert r.tpkt == tpkt and str(r.tbyt) in (tbyt, str(float(tbyt))) and r.cp == cp, name
        assert (r.prtcp, r.prudp, r.pricmp, r.prigmp, r.prother) == protos, name
        assert (r.flga, r.flgs, r.flgf, r.flgr, r.flgp, r.flgu) == flags, name


def test_tbyt_text_is_jvm_double_text(golden):
    out = feat.add_features(flowop.good_rows(golden)).select("key", F.col("tbyt").cast("string").alias("t"))
    got = {r.key.decode(): r.t for r in out.collect()}
    assert got == {k: v[1] for k, v in EXPECTED.items()}


def test_reject_reason(golden):
    rej = {r.key.decode(): r.reject_reason for r in flowop.rejects(golden).collect()}
    assert rej == {"G5": "dp is not a number"}


def test_strict_mode_raises(spark, golden):
    rows = [(b"G5", GOLDEN["G5"].encode(), "t", 0, 0)]
    env = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint")
    strict = flowop.parse_flow(env, mode="strict")
    # whichever columns are read
    for out in (strict, strict.select("sa"), strict.select("key"), strict.select(flowop.to_flow_line(strict, schemas.flow_columns()))):
        with pytest.raises(Exception, match="dp is not a number"):
            out.collect()
    good = spark.createDataFrame([(b"G1", GOLDEN["G1"].encode(), "t", 0, 0)], env.schema)
    assert flowop.parse_flow(good, mode="strict").count() == 1


def test_ragged_records(spark):
    line = GOLDEN["G1"]
    rows = [("short", "a,b,c"), ("47", line.rsplit(",", 1)[0]), ("48", line), ("49", line + ",x"), ("60", line + ",y" * 12), ("null", None), ("empty", "")]
    env = spark.createDataFrame([(k.encode(), v.encode() if v is not None else None) for k, v in rows], "key binary, value binary")
    p = flowop.parse_flow(env)
    got = {r.key.decode(): r for r in p.select("*", flowop.to_flow_line(p, schemas.flow_columns()).alias("line")).collect()}
    assert {k: r.reject_reason for k, r in got.items()} == {
        "short": "fewer than 48 cells", "47": "fewer than 48 cells", "48": None, "49": None, "60": None, "null": "null record", "empty": "fewer than 48 cells"}
    assert {k: r.rejected_record for k, r in got.items() if r.reject_reason} == {k: v for k, v in rows if k in ("short", "47", "null", "empty")}
    assert [got[k].line for k in ("48", "49", "60")] == [line, line + ",x", line + ",y" * 12]
    out = feat.add_features(flowop.good_rows(p))
    cols = schemas.flow_columns() + list(schemas.DERIVED_COLUMNS)
    full = {r.key.decode(): r.line for r in out.select("key", flowop.to_flow_line(out, cols).alias("line")).collect()}
    assert full["49"].startswith(line + ",x,4,460.0,1,") and len(full["60"].split(",")) == 60 + 14


def test_header_from_a_file(spark, tmp_path):
    path = tmp_path / "header.csv"
    path.write_text(schemas.DEFAULT_FLOW_HEADER + "\n")
    assert schemas.read_flow_header(spark, str(path)) == schemas.flow_columns() == schemas.read_flow_header(spark, None)


def test_line_round_trip_keeps_whitespace(golden):
    out = golden.select("key", flowop.to_flow_line(golden, schemas.flow_columns()).alias("line")).collect()
    assert {r.key.decode(): r.line for r in out} == GOLDEN


def test_appended_line_has_62_cells(golden):
    cols = schemas.flow_columns() + list(schemas.DERIVED_COLUMNS)
    out = feat.add_features(flowop.good_rows(golden))
    lines = [r.line for r in out.select(flowop.to_flow_line(out, cols).alias("line")).collect()]
    assert all(len(line.split(",")) == 62 for line in lines)


def test_trailing_empty_cells(spark):
    line = "a,b,,"
    env = spark.createDataFrame([(b"k", line.encode())], "key binary, value binary")
    keep = env.select(flowop.split_cells(F.col("value").cast("string")).alias("c")).first().c
    compat = env.select(flowop.split_cells(F.col("value").cast("string"), compat_trailing=True).alias("c")).first().c
    assert keep == ["a", "b", "", ""] and compat == ["a", "b"]


def test_header_resolves_by_name():
    cols = schemas.flow_columns("da,sa,ts")
    assert cols == ["da", "sa", "ts"]
    with pytest.raises(ValueError):
        schemas.flow_columns("a,,b")
