"""A persisted mapping of addresses that grows over batches and runs (A2, A3).

The store is a folder of Parquet files under a shared file system:

* ``pairs/batch=<name>/attempt=<id>/bucket=<b>``: what a batch added, sorted by
  address, in ``n_buckets`` buckets by a hash of the address;
* ``commits/<name>-<attempt>``: one row that says an attempt is whole. It is written after
  the pairs; readers take only attempts that have one.

A batch's distinct sensitive addresses are anti-joined with the store, so only
addresses never seen before reach the cipher. The name of a batch is that of its run
and its number. A batch that is committed is not added again: a replay reads the store and
gets the same pseudonyms. An attempt that failed leaves files that nobody reads.

``compact`` rewrites all pairs as one batch in as many files as there are buckets; its commit row names what it
replaces, so readers go over to it at once.

There is one writer at a time (as one streaming query is). Crypto-PAn is a
function of the key: pairs added by two writers at once would be equal, and
``read`` gives one row for each address even then.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.functions import cryptopan as cp
from netsift.operators import anonymize as anon
from netsift.session import path_exists

PAIR = "original_ip string, obfuscated_ip string, family int, first_batch string, bucket int, batch string, attempt string"
COMMIT = "batch string, attempt string, n_pairs bigint, committed_at timestamp, n_buckets int, key_check string, replaces array<string>"
#: An address whose pseudonym tells whether a store was made with the same key; from the range for documentation.
CHECK_ADDRESS = "192.0.2.1"
# distinct addresses of a batch that are broadcast to the scan of the store: some 10 MB
MAX_BROADCAST_ADDRESSES = 100_000


class MappingStore:
    """Addresses and pseudonyms of all batches so far, in the folder ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: cp.Key, n_buckets: int = 32):
        self._spark, self._root, self._key = spark, root, key
        self._check = cp.with_key(spark.range(1), key).selectExpr(f"sha2({cp.cryptopan_sql(repr(CHECK_ADDRESS), key)}, 256) AS c").first().c
        found = self._commits()
        if any(c.key_check != self._check for c in found):
            raise ValueError(f"the mapping store {root} was made with another key")
        self._buckets = found[0].n_buckets if found else n_buckets

    def _commits(self) -> list:
        """The commit rows: one for each batch since the last compaction, and few before it."""
        path = os.path.join(self._root, "commits")
        return self._spark.read.schema(COMMIT).json(os.path.join(path, "*")).collect() if path_exists(self._spark, path) else []

    def _current(self) -> list:
        """The commits that count: the first of each batch, without those that a compaction replaces."""
        first: dict = {}
        for c in sorted(self._commits(), key=lambda c: (c.committed_at, c.attempt)):
            first.setdefault(c.batch, c)
        gone = {b for c in first.values() for b in c.replaces}
        return [c for c in first.values() if c.batch not in gone]

    def has(self, batch: str) -> bool:
        """Is the batch in the store, by itself or in a compaction?"""
        return any(batch == c.batch or batch in c.replaces for c in self._commits())

    def _pairs(self) -> DataFrame:
        paths = [os.path.join(self._root, "pairs", f"batch={c.batch}", f"attempt={c.attempt}") for c in self._current() if c.n_pairs]
        if not paths:
            return self._spark.createDataFrame([], PAIR)
        return self._spark.read.option("basePath", os.path.join(self._root, "pairs")).schema(PAIR).parquet(*paths)

    def read(self) -> DataFrame:
        """``original_ip, obfuscated_ip, family, first_batch``: one row for each address."""
        grouped = self._pairs().groupBy("original_ip").agg(F.min(F.struct("obfuscated_ip", "family", "first_batch")).alias("x"))
        return grouped.select("original_ip", "x.*")

    def _bucket(self):
        return F.pmod(F.xxhash64("original_ip"), F.lit(self._buckets)).cast("int")

    def _of(self, ips: DataFrame, how: str) -> DataFrame:
        """Rows of ``ips`` with (``left_anti``: without) their pair. Few addresses are broadcast to the scan of the store,
        which then skips buckets that hold none of them; many are shuffled with it."""
        keyed = ips.withColumn("bucket", self._bucket())
        pairs = self._pairs().select("bucket", "original_ip", "obfuscated_ip")
        if how == "left_anti":
            wanted = keyed.select("bucket", "original_ip").distinct()
            small = wanted.count() <= MAX_BROADCAST_ADDRESSES
            known = pairs.join(F.broadcast(wanted) if small else wanted, ["bucket", "original_ip"], "left_semi").select("original_ip").distinct()
            return ips.join(known, "original_ip", "left_anti")
        once = pairs.join(keyed, ["bucket", "original_ip"]).drop("bucket")
        return once.dropDuplicates(["original_ip"])

    def pending(self, ips: DataFrame) -> DataFrame:
        """The addresses of ``ips`` (``original_ip, family``, distinct) that the store lacks: only these meet the cipher."""
        return self._of(ips, "left_anti")

    def add(self, ips: DataFrame, batch: str) -> DataFrame:
        """Add a batch's distinct addresses (``original_ip, family``); returns their mapping, old and new pairs alike.

        A replayed batch that is committed adds nothing.
        """
        ips = anon.materialize(ips)
        if not self.has(batch):
            new = anon.materialize(anon.build_mapping(self.pending(ips.select("original_ip", "family")), self._key))
            self._write(new.withColumn("first_batch", F.lit(batch)), batch, [])
        return self._of(ips, "inner")

    def _write(self, pairs: DataFrame, batch: str, replaces: list[str]) -> None:
        attempt = uuid.uuid4().hex[:12]
        out = pairs.select("original_ip", "obfuscated_ip", "family", "first_batch", self._bucket().alias("bucket"))
        path = os.path.join(self._root, "pairs", f"batch={batch}", f"attempt={attempt}")
        # one file a bucket
        out.repartition(self._buckets, "bucket").sortWithinPartitions("bucket", "original_ip").write.partitionBy("bucket").parquet(path)
        n = pairs.count()
        row = [(batch, attempt, n, self._buckets, self._check, replaces)]
        commit = self._spark.createDataFrame(row, "batch string, attempt string, n_pairs bigint, n_buckets int, key_check string, replaces array<string>")
        commit.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.json(os.path.join(self._root, "commits", f"{batch}-{attempt}"))

    def compact(self) -> None:
        """All pairs as one batch. Its name lists the replaced ones, so that replays of these still add nothing."""
        old = self._current()
        if len(old) < 2:
            return
        replaces = sorted({b for c in old for b in (c.batch, *c.replaces)})
        self._write(anon.materialize(self.read()), f"compacted-{uuid.uuid4().hex[:12]}", replaces)
