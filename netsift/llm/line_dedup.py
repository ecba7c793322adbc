"""Line dedup with levelled sorted runs of line hashes.

Documents come in batches of ascending ids. ``LineRuns`` holds the hashes of all
lines seen so far as tables in the shared folder, bucketed and sorted by hash,
so a batch merges with them without moving them. A batch's keys are anti-joined
with every run; what is left becomes a new run at level 0. A level that has
``fanout`` runs is merged into one run of the next level, so a batch meets only
logarithmically many. A line of a batch goes if its key is in an older run, or
if a smaller id of the same batch has it.

Keys are 128-bit hashes of the line without white space at both ends and with A-Z
lower-cased. Keys of fewer than ``min_chars`` code points never go.

A batch holds ``BATCH_BYTES`` of text, more where there would be over ``MOST_BATCHES``. The runs have a bucket
for every ``BUCKET_KEYS`` occurrences of keys, up to ``MOST_BUCKETS``, so tasks keep their size as the corpus grows.
A batch leaves a table of the keys that others have too; one join finds the lines that have them, and both of its sides
come straight from a shuffle (or one is small and broadcast), so that adaptive execution can split a line found in a third of all documents.

Defined results: a null or empty text is one empty line. A null id counts as
one document after all others. Rows repeating an id are one document: they do not
make each other's lines repeated. Equal lines of one document stay or go together. Texts are split in
slabs of some megabytes; a longer text is a slab of its own. An empty table gives no rows; other columns are kept by
``drop_lines`` and ignored by the rest.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import columns_as, free_names, text_bytes
from netsift.llm.pretokens import slabs
from netsift.session import scratch_path

SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: Batches at least, and the bytes of text in one.
BATCHES = 4
BATCH_BYTES = 4 << 30
#: Batches at most, one after the other: a larger corpus has larger ones.
MOST_BATCHES = 16
FANOUT = 2
#: Occurrences of keys for one bucket of the runs: what a task reads of each run is a part of this.
BUCKET_KEYS = 500_000
MOST_BUCKETS = 50_000
LAST = 2**63 - 1
SLAB = 4 << 20


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The 128-bit key of a line, or None where it is too short to count."""
    key = line.strip(SPACE_BYTES).lower()  # of bytes: ASCII letters only
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def occurrences(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``d, x, h``: the keys of each document, once for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
            for slab in slabs(rows, lambda r: len(r[2].as_buffer() or b""), SLAB):
                ids, own, keys = [], [], []
                for d, x, text in slab:
                    raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                    found = {line_key(line, min_chars) for line in raw.split(b"\n")} - {None}
                    ids += [d] * len(found)
                    own += [x] * len(found)
                    keys += found
                cols = [pa.array(ids, pa.int64()), pa.array(own, pa.binary()), pa.array(keys, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["d", "x", "h"])

    return _numbered(docs, id_col, text_col).mapInArrow(run, "d bigint, x binary, h binary")


def _who(id_: Column, text: Column) -> list[Column]:
    """``d``, the id as a number, and ``x``, which is empty but for null ids: there a hash of the text tells rows apart."""
    x = F.when(id_.isNull(), F.unhex(F.md5(F.coalesce(text, F.lit(""))))).otherwise(F.lit(b""))
    return [F.coalesce(id_.cast("bigint"), F.lit(LAST)).alias("d"), x.alias("x")]


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return columns_as(docs, id=id_col, text=text_col).select(*_who(F.col("id"), F.col("text")), "text")


class LineRuns:
    """The line hashes seen so far: for each level, sorted runs that share no hash."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int = 1):
        self._spark = spark
        self._fanout = fanout
        self._buckets = buckets
        self.levels: list[list[str]] = []

    def _write(self, keys: DataFrame) -> tuple[str, str]:
        """A new run's table and the path of its files."""
        name = f"line_run_{uuid.uuid4().hex}"
        sorted_ = keys.repartition(self._buckets, "h").sortWithinPartitions("h")
        path = scratch_path(self._spark, name)
        sorted_.write.bucketBy(self._buckets, "h").sortBy("h").option("path", path).saveAsTable(name)
        return name, path

    def _put(self, level: int, run: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self._fanout:
            merged = self._spark.table(self.levels[level][0])
            for other in self.levels[level][1:]:
                merged = merged.unionByName(self._spark.table(other))
            whole, _ = self._write(merged)
            for old in self.levels[level]:
                self._spark.sql(f"DROP TABLE {old}")  # the external files stay until the shared folder is cleared
            self.levels[level] = []
            self._put(level + 1, whole)

    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def close(self) -> None:
        """Take the runs out of the catalog; their files stay until the shared folder is cleared."""
        for run in self.runs():
            self._spark.sql(f"DROP TABLE {run}")
        self.levels = []

    def add(self, batch: DataFrame, last: bool = False) -> DataFrame:
        """Add a batch's ``d, h``; returns ``h, fresh, lo``: the keys found twice. Their lines go, with ``fresh`` those of ids above ``lo`` only.

        ``batch`` must be a written table. After the ``last`` nothing is merged.
        """
        keys = batch.groupBy("h").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
        fresh = keys.select("h")
        for run in self.runs():
            fresh = fresh.join(self._spark.table(run), "h", "left_anti")
        own, path = self._write(fresh)
        # read by path: merging levels drops a run's name, not its files
        own_keys = self._spark.read.schema("h binary").parquet(path).withColumn("fresh", F.lit(True))
        if last:
            self._spark.sql(f"DROP TABLE {own}")
        else:
            self._put(0, own)
        return keys.join(own_keys, "h", "left").filter("fresh is null or hi > lo").select("h", "fresh", "lo")


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int | None = None, fanout: int = FANOUT
) -> DataFrame:
    """``d, x, drop``: for documents that lose lines, the keys of those lines."""
    spark = docs.sparkSession
    found = occurrences(docs, id_col, text_col, min_chars)
    if not batches:
        n_bytes = text_bytes(docs.select(F.col(f"`{text_col}`").alias("text")))
        batches = min(MOST_BATCHES, max(BATCHES, math.ceil(n_bytes / BATCH_BYTES)))
    shares = [(i + 1) / batches for i in range(batches - 1)]
    bounds = _numbered(docs, id_col, text_col).agg(F.percentile_approx("d", shares, 10_000)).first()[0] if shares else []
    number = sum([F.when(F.col("d") > b, 1).otherwise(0) for b in bounds or []], F.lit(0))
    path, marks = scratch_path(spark, "line-occurrences"), scratch_path(spark, "line-marks")
    found.withColumn("batch", number).write.partitionBy("batch").parquet(path)
    table = spark.read.schema("d bigint, x binary, h binary, batch int").parquet(path)
    runs = LineRuns(spark, fanout, min(MOST_BUCKETS, max(1, math.ceil(table.count() / BUCKET_KEYS))))
    for i in range(batches):
        mark = runs.add(table.filter(F.col("batch") == i).select("d", "h"), last=i == batches - 1)
        mark.write.parquet(f"{marks}/batch={i}")
    runs.close()
    marked = spark.read.schema("h binary, fresh boolean, lo bigint, batch int").parquet(marks)
    gone = table.join(marked, ["batch", "h"]).filter("fresh is null or d > lo")
    return gone.groupBy("d", "x").agg(F.collect_set("h").alias("drop"))


def drop_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int | None = None, fanout: int = FANOUT
) -> DataFrame:
    """``docs`` with the kept lines in ``text_col``, and ``n_lines, n_dropped`` (before dropping, dropped).

    Where ``docs`` have such a column already, the count's name gets an underscore behind it.
    """
    return _rewrite(docs, id_col, text_col, min_chars, batches, fanout, [c for c in docs.columns if c != text_col])


def _rewrite(docs: DataFrame, id_col: str, text_col: str, min_chars: int, batches: int | None, fanout: int, keep: list[str], digest: bool = False) -> DataFrame:
    gone = repeated_lines(docs, id_col, text_col, min_chars, batches, fanout)
    others = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("_"))
    rows = docs.select(*_who(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.col(f"`{text_col}`").alias("t"), others.alias("o"))
    joined = rows.join(gone, ["d", "x"], "left")
    shape = joined.select("o").schema["o"].dataType.simpleString()
    schema = f"o {shape}, t string, n_lines bigint, n_dropped bigint"

    def run(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in part:
            rows = zip(range(batch.num_rows), batch.column("t"), batch.column("drop"))
            for slab in slabs(rows, lambda x: len(x[1].as_buffer() or b""), SLAB):
                out, n_lines, n_dropped = [], [], []
                for _, text, drop in slab:
                    raw = text.as_py()
                    lines = (raw or "").encode().split(b"\n")
                    kept = lines
                    if drop.is_valid:
                        away = set(drop.as_py())
                        kept = [x for x in lines if line_key(x, min_chars) not in away]
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(kept))
                    text_out = b"\n".join(kept)
                    out.append(hashlib.sha256(text_out).hexdigest() if digest else text_out.decode() if len(kept) < len(lines) else raw)
                others = batch.column("o").slice(slab[0][0], len(slab))
                cols = [others, pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["o", "t", "n_lines", "n_dropped"])

    done = joined.select("o", "t", "drop").mapInArrow(run, schema)
    name = "kept_sha256" if digest else text_col
    counts = [F.col(c).alias(n) for c, n in zip(("n_lines", "n_dropped"), free_names([*keep, name], "n_lines", "n_dropped"))]
    return done.select(*[F.col("o").getField(c).alias(c) for c in keep], F.col("t").alias(name), *counts)


def line_digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int | None = None, fanout: int = FANOUT
) -> DataFrame:
    """``id, n_lines, n_dropped, kept_sha256`` per row."""
    out = _rewrite(docs, id_col, text_col, min_chars, batches, fanout, [id_col], digest=True)
    return out.select(f"`{id_col}`", "n_lines", "n_dropped", "kept_sha256")
