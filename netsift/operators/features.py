"""Derived flow features F1-F14 as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift import schemas
from netsift.functions.ipaddr import trim_sql


def feature_sql(
    pkt_in: str = "ipkt_n",
    pkt_out: str = "opkt_n",
    byt_in: str = "ibyt_n",
    byt_out: str = "obyt_n",
    dst_port: str = "dp_n",
    protocol: str = "pr",
    flags: str = "flg",
) -> dict[str, str]:
    """The 14 derived cells, in output order, as SQL expressions over parsed columns."""
    proto = f"upper({trim_sql(protocol)})"
    flg = f"upper({trim_sql(flags)})"
    ports = ", ".join(str(p) for p in schemas.COMMON_PORTS)
    out = {
        "tpkt": f"CAST({pkt_in} + {pkt_out} AS BIGINT)",
        "tbyt": f"CAST({byt_in} + {byt_out} AS DOUBLE)",
        "cp": f"CAST({dst_port} IN ({ports}) AS INT)",
    }
    for name, label in schemas.NAMED_PROTOCOLS:
        out[name] = f"CAST({proto} = '{label}' AS INT)"
    labels = ", ".join(f"'{label}'" for _, label in schemas.NAMED_PROTOCOLS)
    out["prother"] = f"CAST({proto} NOT IN ({labels}) AS INT)"
    for name, letter in schemas.FLAG_LETTERS:
        out[name] = f"CAST(instr({flg}, '{letter}') > 0 OR instr({flg}, 'X') > 0 AS INT)"
    return out


def feature_columns(**kwargs) -> dict[str, Column]:
    """The 14 derived cells as Columns (see ``feature_sql``)."""
    return {name: F.expr(sql) for name, sql in feature_sql(**kwargs).items()}


def add_features(parsed: DataFrame) -> DataFrame:
    """Append tpkt, tbyt, cp, the protocol one-hot and the flag cells."""
    return parsed.selectExpr("*", *[f"{sql} AS {name}" for name, sql in feature_sql().items()])
