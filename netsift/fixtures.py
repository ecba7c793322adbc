"""Record streams derived from the shared test tables.

The flow and log inputs of this library are delimited text records inside a
message envelope. The test tables hold neither, so these functions derive
them deterministically, as Spark transformations of ``events`` and
``documents`` (whole tables, whole texts), so that every query's work grows
with the input. The same derivations are written in DuckDB SQL for the oracle
(``netsift.plans.common``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; a small file is spread over the cores (see ``session.spread``)."""
    from netsift.session import spread

    return spread(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))


# Cell expressions of a derived flow, in Spark SQL (see FIXTURES.md §2.1).
FLOW_EXPRS = {
    "k": "event_id",
    "key_text": "lpad(cast((event_id * 7919) % 100003 as string), 6, '0')",
    "ts": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "sa": "concat('10.10.', cast(case when user_id % 3 = 0 then 5 when user_id % 3 = 1 then 11 else 77 end as string),"
          " '.', cast(event_id % 256 as string))",
    "da": "case when event_id % 5 = 0 then concat('fddd:be2e:c6ba::', cast(event_id % 10 as string))"
          " when event_id % 5 = 1 then concat('2001:db8::', cast(event_id % 10 as string))"
          " else concat('192.168.10.', cast(user_id % 256 as string)) end",
    "sp": "1024 + event_id % 60000",
    "dp": "case when event_id % 50 = 49 then '' else case event_id % 8 when 0 then '80' when 1 then '443'"
          " when 2 then '53' when 3 then '22' when 4 then '5190' when 5 then '8080' when 6 then '143'"
          " else '50000' end end",
    "pr": "case event_id % 6 when 0 then 'TCP' when 1 then 'udp' when 2 then 'ICMP' when 3 then 'IGMP'"
          " when 4 then 'GRE' else ' tcp ' end",
    "flg": "case event_id % 7 when 0 then '.AP.SF' when 1 then '....S.' when 2 then '...R..' when 3 then 'X'"
           " when 4 then 'U.a...' when 5 then '......' else '.A..SF' end",
    "ipkt": "event_id % 97",
    "ibyt": "(event_id % 97) * 64",
    "opkt": "case when event_id % 4 = 0 then 0 else user_id % 53 end",
    "obyt": "case when event_id % 4 = 0 then 0 else (user_id % 53) * 1500 end",
}

FLOW_LINE = (
    "concat(ts, ',', ts, ',0.5,', sa, ',', da, ',', cast(sp as string), ',', dp, ',', pr, ',', flg, ',0,0,',"
    " cast(ipkt as string), ',', cast(ibyt as string), ',', cast(opkt as string), ',', cast(obyt as string),"
    " repeat(',0', 33))"
)


def flow_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed source columns of the derived flows (one per event)."""
    events = table(spark, sf_dir, "events")
    return events.selectExpr(*[f"{expr} as {name}" for name, expr in FLOW_EXPRS.items()])


# The same records, some of them ragged: 47, 49 and 60 cells, three cells, no value, numbers that do not parse.
RAGGED_LINE = (
    "case k % 97 when 8 then 'a,b,c' when 9 then cast(null as string) else concat(ts, ',', ts, ',0.5,', sa, ',', da, ',',"
    " cast(sp as string), ',', dp, ',', pr, ',', flg, ',0,0,', if(k % 97 = 10, 'x', cast(ipkt as string)), ',',"
    " if(k % 97 = 11, '', cast(ibyt as string)), ',', cast(opkt as string), ',', cast(obyt as string),"
    " repeat(',0', case k % 97 when 5 then 32 when 6 then 34 when 7 then 45 else 33 end)) end"
)


def flow_envelope(spark: SparkSession, sf_dir: str, topic: str = "netflow-raw", line: str = FLOW_LINE) -> DataFrame:
    """Flow records as a message source delivers them (key, value, topic, partition, offset, ...)."""
    flows = flow_table(spark, sf_dir)
    return flows.select(
        F.encode("key_text", "UTF-8").alias("key"),
        F.encode(F.expr(line), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("k") % 3).cast("int").alias("partition"),
        F.col("k").alias("offset"),
        F.to_timestamp(F.col("ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


SYSLOG_LINE = (
    "concat('Oct ', cast(1 + doc_id % 28 as string), ' 22:14:', lpad(cast(doc_id % 60 as string), 2, '0'),"
    " ' host', cast(doc_id % 7 as string), ' app', cast(doc_id % 5 as string),"
    " case when doc_id % 11 = 0 then '' else concat('[', cast(doc_id as string), ']') end, ': ',"
    " regexp_replace(text, '[\\\\s]+', ' '))"
)


def syslog_envelope(spark: SparkSession, sf_dir: str, topic: str = "syslog-raw") -> DataFrame:
    """Log lines (one per document, whole text, whitespace runs folded) in an envelope."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(F.expr(SYSLOG_LINE), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("doc_id") % 3).cast("int").alias("partition"),
        F.col("doc_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
