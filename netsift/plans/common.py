"""Shared pieces of the registered queries: parsed flows, parsed logs, oracle CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netsift import fixtures, schemas
from netsift.operators import flow as flowop

# the shipped policy (one rule per line)
POLICY = ("10.10.5.0/24", "10.10.11.0/24", "192.168.10.0/24", "fddd:be2e:c6ba::/116")

# Crypto-PAn key of the public sample trace; for tests and the registered queries only
SAMPLE_KEY = bytes([
    21, 34, 23, 141, 51, 164, 207, 128, 19, 10, 91, 22, 73, 144, 125, 16,
    216, 152, 143, 131, 121, 121, 101, 39, 98, 87, 76, 45, 42, 132, 34, 2,
])


def parsed_flows(spark: SparkSession, sf_dir: str, line: str = fixtures.FLOW_LINE) -> DataFrame:
    """Envelope -> named cells, typed views and reject reason; ``k`` is the offset."""
    env = fixtures.flow_envelope(spark, sf_dir, line=line)
    parsed = flowop.parse_flow(env)
    return parsed.withColumnRenamed("offset", "k")


# DuckDB text of the derived flow table (FIXTURES.md §2.1); prepend to a query as a CTE.
FLOW_CTE = """
flow AS (
  SELECT event_id AS k,
    lpad(CAST((event_id * 7919) % 100003 AS VARCHAR), 6, '0') AS key_text,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
    concat('10.10.', CAST(CASE WHEN user_id % 3 = 0 THEN 5 WHEN user_id % 3 = 1 THEN 11 ELSE 77 END AS VARCHAR),
           '.', CAST(event_id % 256 AS VARCHAR)) AS sa,
    CASE WHEN event_id % 5 = 0 THEN concat('fddd:be2e:c6ba::', CAST(event_id % 10 AS VARCHAR))
         WHEN event_id % 5 = 1 THEN concat('2001:db8::', CAST(event_id % 10 AS VARCHAR))
         ELSE concat('192.168.10.', CAST(user_id % 256 AS VARCHAR)) END AS da,
    1024 + event_id % 60000 AS sp,
    CASE WHEN event_id % 50 = 49 THEN ''
         ELSE CASE event_id % 8 WHEN 0 THEN '80' WHEN 1 THEN '443' WHEN 2 THEN '53' WHEN 3 THEN '22'
              WHEN 4 THEN '5190' WHEN 5 THEN '8080' WHEN 6 THEN '143' ELSE '50000' END END AS dp,
    CASE event_id % 6 WHEN 0 THEN 'TCP' WHEN 1 THEN 'udp' WHEN 2 THEN 'ICMP' WHEN 3 THEN 'IGMP'
         WHEN 4 THEN 'GRE' ELSE ' tcp ' END AS pr,
    CASE event_id % 7 WHEN 0 THEN '.AP.SF' WHEN 1 THEN '....S.' WHEN 2 THEN '...R..' WHEN 3 THEN 'X'
         WHEN 4 THEN 'U.a...' WHEN 5 THEN '......' ELSE '.A..SF' END AS flg,
    event_id % 97 AS ipkt, (event_id % 97) * 64 AS ibyt,
    CASE WHEN event_id % 4 = 0 THEN 0 ELSE user_id % 53 END AS opkt,
    CASE WHEN event_id % 4 = 0 THEN 0 ELSE (user_id % 53) * 1500 END AS obyt
  FROM events
),
flow_line AS (
  SELECT *, concat(ts, ',', ts, ',0.5,', sa, ',', da, ',', CAST(sp AS VARCHAR), ',', dp, ',', pr, ',', flg, ',0,0,',
         CAST(ipkt AS VARCHAR), ',', CAST(ibyt AS VARCHAR), ',', CAST(opkt AS VARCHAR), ',', CAST(obyt AS VARCHAR),
         repeat(',0', 33)) AS line
  FROM flow
)"""

# The ragged records (fixtures.RAGGED_LINE), after FLOW_CTE: their text, number of cells and reason of rejection.
RAGGED_CTE = """
ragged_line AS (
  SELECT *, CASE k % 97 WHEN 8 THEN 'a,b,c' WHEN 9 THEN NULL ELSE
    concat(ts, ',', ts, ',0.5,', sa, ',', da, ',', CAST(sp AS VARCHAR), ',', dp, ',', pr, ',', flg, ',0,0,',
           CASE WHEN k % 97 = 10 THEN 'x' ELSE CAST(ipkt AS VARCHAR) END, ',',
           CASE WHEN k % 97 = 11 THEN '' ELSE CAST(ibyt AS VARCHAR) END, ',', CAST(opkt AS VARCHAR), ',', CAST(obyt AS VARCHAR),
           repeat(',0', CASE k % 97 WHEN 5 THEN 32 WHEN 6 THEN 34 WHEN 7 THEN 45 ELSE 33 END)) END AS rline
  FROM flow
),
ragged AS (
  SELECT *, len(string_split(rline, ',')) AS n_cells,
    CASE WHEN rline IS NULL THEN 'null record' WHEN len(string_split(rline, ',')) < 48 THEN 'fewer than 48 cells'
         WHEN dp = '' THEN 'dp is not a number' WHEN k % 97 = 10 THEN 'ipkt is not a number'
         WHEN k % 97 = 11 THEN 'ibyt is not a number' END AS reason
  FROM ragged_line
)"""

# DuckDB feature expressions over the flow CTE (good rows: dp <> '')
PORTS_SQL = ", ".join(map(str, schemas.COMMON_PORTS))
FEATURES_SQL = """
    CAST(ipkt + opkt AS BIGINT) AS tpkt,
    CAST(ibyt + obyt AS DOUBLE) AS tbyt,
    CAST(CAST(dp AS INTEGER) IN (""" + PORTS_SQL + """) AS INTEGER) AS cp,
    CAST(upper(trim(pr)) = 'TCP' AS INTEGER) AS prtcp,
    CAST(upper(trim(pr)) = 'UDP' AS INTEGER) AS prudp,
    CAST(upper(trim(pr)) = 'ICMP' AS INTEGER) AS pricmp,
    CAST(upper(trim(pr)) = 'IGMP' AS INTEGER) AS prigmp,
    CAST(upper(trim(pr)) NOT IN ('TCP', 'UDP', 'ICMP', 'IGMP') AS INTEGER) AS prother,
    CAST(contains(upper(trim(flg)), 'A') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flga,
    CAST(contains(upper(trim(flg)), 'S') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flgs,
    CAST(contains(upper(trim(flg)), 'F') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flgf,
    CAST(contains(upper(trim(flg)), 'R') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flgr,
    CAST(contains(upper(trim(flg)), 'P') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flgp,
    CAST(contains(upper(trim(flg)), 'U') OR contains(upper(trim(flg)), 'X') AS INTEGER) AS flgu"""


def with_cte(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"

