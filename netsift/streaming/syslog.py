"""Log streams: parse -> TF-IDF with a fitted model -> output line."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netsift.operators import syslog as sl


def syslog_lines(source: DataFrame, model: PipelineModel, keep=()) -> DataFrame:
    """Envelope or text rows -> ``value`` = ``timestamp,hostname,appname,pid,<dense TF-IDF>``."""
    scored = sl.score(sl.parse_syslog(source, keep=keep), model)
    return sl.to_syslog_line(scored, keep=keep)


def start_syslog(
    source: DataFrame,
    model: PipelineModel,
    *,
    fmt: str = "kafka",
    checkpoint: str,
    options: dict | None = None,
    console: bool = False,
    available_now: bool = False,
    name: str = "Parse Kafka Stream",
) -> list[StreamingQuery]:
    """Start the scoring query (K4) and, with ``console``, a console preview in update mode (K5, R2)."""
    lines = syslog_lines(source, model)
    out = lines.select(F.col("value").cast("binary").alias("value")) if fmt == "kafka" else lines
    w = out.writeStream.queryName(name).format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    w = w.options(**(options or {}))
    if available_now:
        w = w.trigger(availableNow=True)
    started = [w.start()]
    if console:
        c = lines.writeStream.format("console").outputMode("update").option("truncate", "false")
        if available_now:
            c = c.trigger(availableNow=True)
        started.append(c.start())
    return started
