"""SimHash near-dedup by anchor-point covering.

Fingerprints within ``T`` = 4 bits agree up to one bit on at least one of three
blocks of 22, 21 and 21 bits. On each block the anchors are a covering code: the
perfect Hamming code on 15 bits (covering radius 1) with the other bits of the
block as they are. A fingerprint's home is its nearest anchor; it is copied to
every anchor within the covering radius plus one bit, so two fingerprints
one bit apart on a block meet at the home of either. (A code over all 64 bits
would need hundreds of copies for the same selectivity.) At each anchor the homes
are compared with all copies by their 64 bits.

Only distinct fingerprints are compared. What an anchor finds leaves the task
as a spanning forest, not as pairs, and components are joined up by
``components``. Anchors with more than ``TILE_ROWS`` copies are cut into tiles
of two salted parts, each a group of its own, so none is too large for a task.

Defined results: a null or empty text, or one without words, has fingerprint
zero and links like any other; rows with a null id take part but never name a
component unless it has no other id; an empty table gives no rows; other columns
are ignored. A very long text is hashed whole, its bits counted in parts of ``SHINGLES``
shingles. A bit set in just half of the hashes (a tie) is 0. Rows repeating a text or an id are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.common import columns_as, materialize
from netsift.llm.components import components
from netsift.llm.pretokens import slabs

#: Maximum differing bits, and the first bit and width of the three blocks.
T = 4
BLOCKS = ((0, 22), (22, 21), (43, 21))
CODE_BITS = 15
TILE_ROWS = 16_384
#: Comparisons and shingles held at once.
PAIRS = 1 << 21
SHINGLES = 1 << 17
SEED = 42


def shingle_hashes(text: str | None, width: int) -> list[int]:
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return []
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-width].tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]


def fingerprints(texts: list[str | None], width: int = 4) -> np.ndarray:
    """A 64-bit SimHash of each text; bits are set in over half of its shingle hashes."""
    out = np.zeros(len(texts), np.uint64)
    for i, t in enumerate(texts):
        h = shingle_hashes(t, width)
        if h:
            ones = np.zeros(64, np.int64)
            for lo in range(0, len(h), SHINGLES):
                part = np.array(h[lo : lo + SHINGLES], "<u8").view(np.uint8).reshape(-1, 8)
                ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
    return out


def add_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """``id, fp`` (signed 64-bit) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(range(batch.num_rows), batch.column(1))
            for slab in slabs(((i, t.as_py()) for i, t in rows), lambda x: len(x[1] or ""), 4 << 20):
                fp = fingerprints([t for _, t in slab], width).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(slab[0][0], len(slab)), pa.array(fp)], ["id", "fp"])

    kind = dict(docs.dtypes)[id_col]
    return columns_as(docs, id=id_col, text=text_col).mapInArrow(run, f"id {kind}, fp bigint")


def _syndrome(word: np.ndarray) -> np.ndarray:
    """Position 1 to 15 of the bit to flip for the nearest codeword; 0 for a codeword."""
    s = np.zeros_like(word)
    for i in range(CODE_BITS):
        s ^= np.where(word >> i & 1, i + 1, 0)
    return s


def anchors(fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``row, anchor, away`` of every copy; away is 0 where the anchor is the row's home."""
    rows = np.arange(len(fp))
    for block, (lo, width) in enumerate(BLOCKS):
        word = (fp >> np.uint64(lo)).astype(np.int64) & ((1 << width) - 1)
        tag = block << 22
        s = _syndrome(word & ((1 << CODE_BITS) - 1))
        flip = np.where(s > 0, 1 << np.maximum(s - 1, 0), 0)
        home = word ^ flip
        yield rows, tag | home, np.zeros(len(fp), np.int64)
        for i in range(CODE_BITS, width):  # one bit apart outside the code
            yield rows, tag | home ^ (1 << i), np.ones(len(fp), np.int64)
        for i in range(1, CODE_BITS + 1):  # codewords two bits away: positions i and i ^ s
            j = i ^ s
            two = (s > 0) & (i < j)
            at = rows[two]
            yield at, tag | word[two] ^ (1 << (i - 1)) ^ (1 << (j[two] - 1)), np.ones(len(at), np.int64)


def copies(distinct: DataFrame) -> DataFrame:
    """``anchor, away, fp``: each fingerprint at its homes and at every anchor within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for at, anchor, away in anchors(fp.view(np.uint64)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype(np.int32)), pa.array(away.astype(np.int8)), pa.array(fp[at])], ["anchor", "away", "fp"]
                )

    return distinct.select("fp").mapInArrow(run, "anchor int, away tinyint, fp bigint")


def tiled(spread: DataFrame, tile_rows: int) -> DataFrame:
    """Add ``tile``: 0, or for each pair of salted parts of a crowded anchor a tile of its own.

    A part is in as many tiles as there are parts, so every two copies share one.
    """
    crowded = spread.groupBy("anchor").count().filter(F.col("count") > tile_rows)
    crowded = materialize(crowded.select("anchor", F.ceil(F.col("count") / (tile_rows / 2)).cast("int").alias("parts")))
    if crowded.isEmpty():
        return spread.withColumn("tile", F.lit(0).cast("bigint"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    mates = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.least(part, o) * F.col("parts") + F.greatest(part, o))
    tiles = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.transform(mates, lambda m: m.cast("bigint")))
    return spread.join(crowded, "anchor", "left").withColumn("tile", F.explode(tiles)).drop("parts")


def forest(fp: np.ndarray, group: np.ndarray, home: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the homes with their groups as ``node, smaller node`` edges that span each component found.

    Rows are sorted by group. Comparisons run in slabs; each slab's links are
    folded into labels at once, so no list of pairs builds up.
    """
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(fp)])
    of = np.repeat(np.arange(len(starts)), sizes)
    label = np.arange(len(fp))
    rows = np.flatnonzero(home & (sizes[of] > 1))
    step, work = 0, np.cumsum(sizes[of[rows]])
    while step < len(rows):
        done = work[step - 1] if step else 0
        upto = max(step + 1, int(np.searchsorted(work, done + PAIRS, side="right")))
        a = rows[step:upto]
        n = sizes[of[a]]
        left = np.repeat(a, n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[of[a]], n)
        near = (np.bitwise_count(fp[left] ^ fp[right]) <= t) & (left != right)
        left, right = left[near], right[near]
        while len(left):  # labels only go down, and stay within a group
            la, lb = label[left], label[right]
            apart = la != lb
            left, right, la, lb = left[apart], right[apart], la[apart], lb[apart]
            if not len(left):
                break
            low = np.minimum(la, lb)
            np.minimum.at(label, np.maximum(la, lb), low)
            np.minimum.at(label, left, low)
            np.minimum.at(label, right, low)
            while not np.array_equal(up := label[label], label):
                label = up
        step = upto
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return fp[linked], fp[label[linked]]


def links(distinct: DataFrame, t: int = T, tile_rows: int | None = None) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints that connect just those within ``t`` bits of each other (by paths)."""
    if t > T:
        raise ValueError(f"the blocks cover up to {T} differing bits")
    spread = tiled(copies(distinct), tile_rows or TILE_ROWS)
    dealt = spread.repartition("anchor", "tile").sortWithinPartitions("anchor", "tile", "away")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("anchor", "tile", "away", "fp")]
            held = [np.concatenate(x) for x in zip(held, now)] if held else now
            last = (held[0] != held[0][-1]) | (held[1] != held[1][-1])
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0  # the last group may go on
            if cut:
                yield out([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held:
            yield out(held)

    def out(cols: list[np.ndarray]) -> pa.RecordBatch:
        anchor, tile, away, fp = cols
        group = np.cumsum(np.r_[False, (anchor[1:] != anchor[:-1]) | (tile[1:] != tile[:-1])])
        a, b = forest(fp.view(np.uint64), group, away == 0, t)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, t: int = T, tile_rows: int | None = None, with_root: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (hex) and ``component_id``, the smallest id reachable.

    ``with_root`` adds ``root``, which tells groups apart that a repeated id names alike.
    """
    rows = materialize(add_fingerprints(docs, id_col, text_col, width))
    distinct = materialize(rows.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(distinct, t, tile_rows), "a", "b")
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "root").select("fp", "component_id", "root")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select(F.col("id").alias(id_col), text.alias("fingerprint"), "component_id", *["root"] * with_root)
