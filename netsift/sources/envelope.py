"""Record sources with the message envelope.

``key binary, value binary, topic string, partition int, offset bigint,
timestamp timestamp, timestampType int``: the schema Spark's Kafka source
gives. The same functions read a Kafka topic (when the connector is on the
classpath) or files holding envelope rows (parquet in tests), batch or stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift import schemas


def kafka_options(
    bootstrap: str,
    topic: str,
    *,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    **extra: str,
) -> dict[str, str]:
    """Options of a Kafka subscription (S1: latest, S2/S3: earliest)."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_envelope(
    spark: SparkSession,
    fmt: str = "kafka",
    *,
    streaming: bool = False,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Envelope rows from a topic or from files, as a batch or a streaming DataFrame."""
    opts = dict(options or {})
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).options(**opts)
    if fmt != "kafka":
        reader = reader.schema(schemas.ENVELOPE)
    return reader.load(path) if path is not None else reader.load()


def read_snapshot(
    spark: SparkSession,
    path: str,
    *,
    start: str | dict[int, int | str] = "earliest",
    end: str | dict[int, int | str] = "latest",
    fail_on_data_loss: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """A bounded read of envelope files by offset (S3, R8, R9): ``[start, end)`` of each partition, fixed when the read is planned.

    ``"earliest"`` and ``"latest"`` (the end so far) are found by one aggregation, as they are
    for partitions that a dict leaves out. The bounds become a filter on ``partition`` and
    ``offset``, which skips files and row groups by their statistics, so records added
    later are not in the snapshot. Offsets are inclusive at the start and exclusive at the end.

    With ``fail_on_data_loss`` a start before the first offset there is, an end behind the last, a partition without
    records, or a gap in between is an error, found before anything is returned; otherwise what is there is read.
    """
    rows = spark.read.format(fmt).schema(schemas.ENVELOPE).load(path)
    known = {r.partition: r for r in rows.groupBy("partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last")).collect()}
    named = {p for x in (start, end) if isinstance(x, dict) for p in x}
    bounds = {}
    for p in sorted(known.keys() | named):
        there = known.get(p)
        a = start.get(p, "earliest") if isinstance(start, dict) else start
        b = end.get(p, "latest") if isinstance(end, dict) else end
        for x in (a, b):
            if isinstance(x, str) and x not in ("earliest", "latest"):
                raise ValueError(f"unknown offset {x!r}")
        first, last = (there.first, there.last + 1) if there else (0, 0)
        a, b = ({"earliest": first, "latest": last}.get(x, x) if isinstance(x, str) else x for x in (a, b))
        if fail_on_data_loss and a < b and (there is None or a < first or b > last):
            raise ValueError(f"offsets {a} to {b} of partition {p} are gone: there are {first} to {last}")
        bounds[p] = (a, max(a, b))
    inside = F.lit(False)
    for p, (a, b) in bounds.items():
        if a < b:
            inside = inside | ((F.col("partition") == p) & (F.col("offset") >= a) & (F.col("offset") < b))
    snapshot = rows.filter(inside)
    if fail_on_data_loss:
        held = {r.partition: r.n for r in snapshot.groupBy("partition").agg(F.countDistinct("offset").alias("n")).collect()}
        for p, (a, b) in bounds.items():
            if held.get(p, 0) < b - a:
                raise ValueError(f"partition {p} holds {held.get(p, 0)} of the {b - a} offsets from {a} to {b}")
    return snapshot


def write_envelope(df: DataFrame, fmt: str = "kafka", *, path: str | None = None, topic: str | None = None,
                   options: dict[str, str] | None = None, mode: str = "append") -> None:
    """Batch write of envelope rows (K6): ``key``/``value`` (and ``partition``) to a topic or files."""
    opts = dict(options or {})
    if topic is not None:
        opts["topic"] = topic
    w = df.write.format(fmt).options(**opts)
    if fmt == "kafka":
        w.save()
    else:
        w.mode(mode).save(path)
