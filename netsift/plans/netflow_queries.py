"""Registered flow queries: parsing, features, rejects, address family."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsift import schemas
from netsift.functions import ipaddr
from netsift.operators import features as feat
from netsift.operators import flow as flowop
from netsift.plans.common import FEATURES_SQL, FLOW_CTE, PORTS_SQL, RAGGED_CTE, parsed_flows, with_cte
from netsift.plans.registry import register

FLOW = with_cte(FLOW_CTE)

_SPLIT_CELLS = ("ts", "sa", "da", "sp", "dp", "pr", "flg", "ipkt", "ibyt", "opkt", "obyt", "tr")


@register(
    "flow_split",
    FLOW + """
SELECT k, 48 AS n_cells, ts, sa, da, CAST(sp AS VARCHAR) AS sp, dp, pr, flg,
       CAST(ipkt AS VARCHAR) AS ipkt, CAST(ibyt AS VARCHAR) AS ibyt, CAST(opkt AS VARCHAR) AS opkt,
       CAST(obyt AS VARCHAR) AS obyt, '0' AS tr
FROM flow_line""",
)
def flow_split(spark, sf_dir):
    """Decode the envelope and split the record into named cells."""
    p = parsed_flows(spark, sf_dir)
    return p.select("k", "n_cells", *_SPLIT_CELLS)


@register("flow_join_roundtrip", FLOW + "SELECT k, line, true AS same FROM flow_line")
def flow_join_roundtrip(spark, sf_dir):
    """Cells joined back give the original record text."""
    from netsift import fixtures

    env = fixtures.flow_envelope(spark, sf_dir)
    p = flowop.parse_flow(env, keep=("offset", "value"))
    line = flowop.to_flow_line(p, schemas.flow_columns())
    return p.select(
        F.col("offset").alias("k"), line.alias("line"), (line == F.col("value").cast("string")).alias("same")
    )


@register(
    "flow_header_select",
    FLOW + "SELECT k, sa, da, pr, flg FROM flow",
)
def flow_header_select(spark, sf_dir):
    """Cells chosen by header name, whatever their position."""
    p = parsed_flows(spark, sf_dir)
    return flowop.select_cells(p, ["k", "sa", "da", "pr", "flg"])


@register(
    "flow_totals",
    FLOW + "SELECT k, CAST(ipkt + opkt AS BIGINT) AS tpkt, CAST(ibyt + obyt AS DOUBLE) AS tbyt FROM flow WHERE dp <> ''",
)
def flow_totals(spark, sf_dir):
    """F1 F2: total packets and bytes."""
    p = flowop.good_rows(parsed_flows(spark, sf_dir))
    f = feat.feature_columns()
    return p.select("k", f["tpkt"].alias("tpkt"), f["tbyt"].alias("tbyt"))


@register(
    "flow_common_port",
    FLOW + """
SELECT k, CAST(CAST(dp AS INTEGER) IN (%PORTS%) AS INTEGER) AS cp
FROM flow WHERE dp <> ''""".replace("%PORTS%", PORTS_SQL),
)
def flow_common_port(spark, sf_dir):
    """Destination port of a common service."""
    p = flowop.good_rows(parsed_flows(spark, sf_dir))
    return p.select("k", feat.feature_columns()["cp"].alias("cp"))


@register(
    "flow_protocol_onehot",
    FLOW + """
SELECT k,
    CAST(upper(trim(pr)) = 'TCP' AS INTEGER) AS prtcp,
    CAST(upper(trim(pr)) = 'UDP' AS INTEGER) AS prudp,
    CAST(upper(trim(pr)) = 'ICMP' AS INTEGER) AS pricmp,
    CAST(upper(trim(pr)) = 'IGMP' AS INTEGER) AS prigmp,
    CAST(upper(trim(pr)) NOT IN ('TCP', 'UDP', 'ICMP', 'IGMP') AS INTEGER) AS prother
FROM flow WHERE dp <> ''""",
)
def flow_protocol_onehot(spark, sf_dir):
    """Protocol one-hot; exactly one of the five is 1."""
    p = flowop.good_rows(parsed_flows(spark, sf_dir))
    f = feat.feature_columns()
    return p.select("k", *[f[c].alias(c) for c in ("prtcp", "prudp", "pricmp", "prigmp", "prother")])


@register(
    "flow_tcp_flags",
    FLOW + """
SELECT k,
    CAST(contains(upper(trim(flg)), 'A') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flga,
    CAST(contains(upper(trim(flg)), 'S') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flgs,
    CAST(contains(upper(trim(flg)), 'F') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flgf,
    CAST(contains(upper(trim(flg)), 'R') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flgr,
    CAST(contains(upper(trim(flg)), 'P') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flgp,
    CAST(contains(upper(trim(flg)), 'U') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flgu
FROM flow WHERE dp <> ''""",
)
def flow_tcp_flags(spark, sf_dir):
    """TCP flag letters (X sets all six)."""
    p = flowop.good_rows(parsed_flows(spark, sf_dir))
    f = feat.feature_columns()
    return p.select("k", *[f[c].alias(c) for c, _ in schemas.FLAG_LETTERS])


@register("flow_features_all", FLOW + "SELECT k, sa, da," + FEATURES_SQL + "\nFROM flow WHERE dp <> ''")
def flow_features_all(spark, sf_dir):
    """F1-F14 together on the good rows."""
    p = feat.add_features(flowop.good_rows(parsed_flows(spark, sf_dir)))
    return p.select("k", "sa", "da", *schemas.DERIVED_COLUMNS)


_DERIVED_TEXT = """CAST(ipkt + opkt AS VARCHAR), ',', CAST(CAST(ibyt + obyt AS DOUBLE) AS VARCHAR), ',',
    CAST(CAST(dp AS INTEGER) IN (%PORTS%) AS INTEGER), ',',
    CAST(upper(trim(pr)) = 'TCP' AS INTEGER), ',', CAST(upper(trim(pr)) = 'UDP' AS INTEGER), ',',
    CAST(upper(trim(pr)) = 'ICMP' AS INTEGER), ',', CAST(upper(trim(pr)) = 'IGMP' AS INTEGER), ',',
    CAST(upper(trim(pr)) NOT IN ('TCP', 'UDP', 'ICMP', 'IGMP') AS INTEGER), ',',
    CAST(contains(upper(trim(flg)), 'A') OR contains(upper(trim(flg)), 'X') AS INTEGER), ',',
    CAST(contains(upper(trim(flg)), 'S') OR contains(upper(trim(flg)), 'X') AS INTEGER), ',',
    CAST(contains(upper(trim(flg)), 'F') OR contains(upper(trim(flg)), 'X') AS INTEGER), ',',
    CAST(contains(upper(trim(flg)), 'R') OR contains(upper(trim(flg)), 'X') AS INTEGER), ',',
    CAST(contains(upper(trim(flg)), 'P') OR contains(upper(trim(flg)), 'X') AS INTEGER), ',',
    CAST(contains(upper(trim(flg)), 'U') OR contains(upper(trim(flg)), 'X') AS INTEGER)""".replace("%PORTS%", PORTS_SQL)


@register("flow_append_line", FLOW + f"SELECT k, concat(line, ',', {_DERIVED_TEXT}) AS line FROM flow_line WHERE dp <> ''")
def flow_append_line(spark, sf_dir):
    """The 62-cell record, raw cells then derived cells, as one line."""
    p = feat.add_features(flowop.good_rows(parsed_flows(spark, sf_dir)))
    columns = schemas.flow_columns() + list(schemas.DERIVED_COLUMNS)
    return p.select("k", flowop.to_flow_line(p, columns).alias("line"))


@register(
    "flow_rejects",
    FLOW + "SELECT k, 'dp is not a number' AS reject_reason FROM flow WHERE TRY_CAST(trim(dp) AS INTEGER) IS NULL",
)
def flow_rejects(spark, sf_dir):
    """rows a feature cannot be computed for, with the reason."""
    return flowop.rejects(parsed_flows(spark, sf_dir)).select("k", "reject_reason")


RAGGED = with_cte(FLOW_CTE, RAGGED_CTE)


@register("flow_ragged_roundtrip", RAGGED + "SELECT k, n_cells, rline AS line, true AS same FROM ragged WHERE n_cells >= 48")
def flow_ragged_roundtrip(spark, sf_dir):
    """Records with more cells than the header come back whole."""
    from netsift import fixtures

    env = fixtures.flow_envelope(spark, sf_dir, line=fixtures.RAGGED_LINE)
    p = flowop.whole_rows(flowop.parse_flow(env, keep=("offset", "value")))
    line = flowop.to_flow_line(p, schemas.flow_columns())
    return p.select(
        F.col("offset").alias("k"), "n_cells", line.alias("line"), (line == F.col("value").cast("string")).alias("same")
    )


@register("flow_ragged_append", RAGGED + f"SELECT k, concat(rline, ',', {_DERIVED_TEXT}) AS line FROM ragged WHERE reason IS NULL")
def flow_ragged_append(spark, sf_dir):
    """Derived cells follow the last cell of the record, however many it has."""
    from netsift import fixtures

    p = feat.add_features(flowop.good_rows(parsed_flows(spark, sf_dir, fixtures.RAGGED_LINE)))
    columns = schemas.flow_columns() + list(schemas.DERIVED_COLUMNS)
    return p.select("k", flowop.to_flow_line(p, columns).alias("line"))


@register(
    "flow_ragged_rejects",
    RAGGED + "SELECT k, reason AS reject_reason, rline AS rejected_record FROM ragged WHERE reason IS NOT NULL",
)
def flow_ragged_rejects(spark, sf_dir):
    """short and null records and numbers that do not parse, with the reason and the record's text."""
    from netsift import fixtures

    p = flowop.rejects(parsed_flows(spark, sf_dir, fixtures.RAGGED_LINE))
    return p.select("k", "reject_reason", "rejected_record")


_V6_RE = schemas.IPV6_PATTERN.replace("'", "''")
_V4_RE = r"^((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$"


@register(
    "ip_family",
    FLOW + f"""
SELECT k,
  CASE WHEN regexp_matches(trim(sa), '^(?:{_V6_RE})$') THEN 6 WHEN regexp_matches(trim(sa), '{_V4_RE}') THEN 4 END AS sa_family,
  CASE WHEN regexp_matches(trim(da), '^(?:{_V6_RE})$') THEN 6 WHEN regexp_matches(trim(da), '{_V4_RE}') THEN 4 END AS da_family
FROM flow""",
)
def ip_family(spark, sf_dir):
    """M1: address family of each address cell."""
    p = parsed_flows(spark, sf_dir)
    return p.select("k", ipaddr.ip_family("sa").alias("sa_family"), ipaddr.ip_family("da").alias("da_family"))
