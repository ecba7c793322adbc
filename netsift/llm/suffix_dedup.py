"""Suffix-array dedup: remove bytes covered by a ``width``-byte string that also starts in a smaller document.

1. Documents are packed into shards of some megabytes, written once.
2. Every window of ``width`` bytes is anchored at its leftmost minimum k-gram
   hash, so equal windows have equal anchors. Shards send their anchor hashes to
   buckets, and learn which anchors another document has too. The rest of the
   text cannot repeat and takes no further part.
3. Each shard sorts the suffixes of its remaining text (Larsson-Sadakane
   refinement: ranks by the first 8 bytes, then doubled depths for groups that are
   not sorted yet) and takes their common prefixes (Kasai's bound, in strides).
   Runs of prefixes of ``width`` bytes and more are equal windows: all but those
   of the smallest document go. What is left, one document's windows for each
   string, is sent on as anchors with the bytes around them.
4. A bucket merges the strings of its shards in one sorted list, in which each
   shard's strings are found by binary search; bytes are compared. A shard learns
   which of its windows start in a smaller document elsewhere. With more
   than ``MERGE`` shards this is done in rounds over groups of shards, so what
   meets in one task is bounded however often a string occurs.
5. Each shard cuts the covered bytes out of its documents.

Matches are judged on the input and never cross documents.

Defined results: a null text is empty; a null id counts as larger than any; rows
repeating an id are one document (they remove nothing from each other); of equal strings those of the
smallest id stay, all of them; a text longer than a shard is a shard of its own; an empty
table gives no rows. ``cut_repeats`` keeps the other columns, the digests ignore them.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.common import free_names, materialize

SHARD_BYTES = 6 << 20
MERGE = 256
LAST = 2**63 - 1
#: Text looked at together when anchors are found; small enough for a core's cache.
BLOCK = 1 << 16
PAD = 128
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_BASE = np.uint64(0x100000001B3)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    head = struct.pack(f"<{len(raw)}Q", *map(len, raw))
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(raw))


def unpack_arrays(blob: bytes, *dtypes: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes, at, out = struct.unpack_from(f"<{len(dtypes)}Q", raw), 8 * len(dtypes), []
    for n, t in zip(sizes, dtypes):
        out.append(np.frombuffer(raw, t, n // np.dtype(t).itemsize, at))
        at += n
    return out


def words(buf: np.ndarray, order: str = "<") -> np.ndarray:
    """The 8 bytes at every place of a byte buffer, as a view."""
    return np.ndarray((max(0, len(buf) - 7),), f"{order}u8", buf, 0, (1,))


def padded(text: bytes) -> np.ndarray:
    return np.frombuffer(text + bytes(PAD), np.uint8)


class Anchoring:
    """Windows of ``width`` bytes and the k-grams that anchor them."""

    def __init__(self, width: int):
        if width < 8:
            raise ValueError("windows have 8 bytes at least")
        self.width = width
        self.gram = min(width, max(16, width - 60)) if width > 16 else 8
        self.reach = width - self.gram  # an anchor is at most so far from its window's start
        self.span = self.reach + width  # bytes around an anchor that its windows can hold

    def gram_hash(self, w: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
        """64-bit hash of the k-gram at each place; ``w`` is the words view."""
        h = None
        for k, off in enumerate(sorted({*range(0, self.gram - 7, 8), self.gram - 8})):
            part = w[at.start + off : at.stop + off] if isinstance(at, slice) else w[at + off]
            h = (part if h is None else h ^ part) * _MIX[k % 3]
            h ^= h >> np.uint64(31)
        return h * _MIX[2]

    def find(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of window starts with one anchor: ``lo`` offsets ``(first start, anchor - first start)`` and run lengths.

        Returned as ``first`` (int64) and ``run`` (uint8 pairs: run length, anchor minus first). The text is gone through
        in blocks; of a block only its runs are kept, and the last one may go on in the next.
        """
        w, total = words(buf), max(0, len(buf) - PAD - self.width + 1)
        top = np.uint64(2**64 - (1 << 20))
        ok = lengths >= self.width
        opens, closes = starts[ok], starts[ok] + lengths[ok] - self.width + 1  # the windows of a document start from, to
        firsts, runs, before = [], [], (-2, -1)  # before: the last window's start and anchor
        for lo in range(0, total, BLOCK):
            hi = min(lo + BLOCK, total)
            a, b = np.searchsorted(closes, lo, side="right"), np.searchsorted(opens, hi)
            if a == b:
                continue
            size = hi - lo + self.reach
            h = (self.gram_hash(w, slice(lo, lo + size)) & top) | np.arange(size, dtype=np.uint64)
            step = 1
            while 2 * step <= self.reach + 1:
                h = np.minimum(h[:-step], h[step:])
                step *= 2
            if step < self.reach + 1:
                h = np.minimum(h[: hi - lo], h[self.reach + 1 - step :])
            best = (h & ~top).astype(np.int32)[: hi - lo]
            step = np.zeros(hi - lo + 1, np.int32)
            np.add.at(step, np.maximum(opens[a:b] - lo, 0), 1)
            np.add.at(step, np.minimum(closes[a:b] - lo, hi - lo), -1)
            s = np.flatnonzero(np.cumsum(step[:-1]) > 0)
            best = best[s]
            # two documents side by side have consecutive starts only if windows reach to the end of the first; then anchors differ
            goes_on = before == (lo + int(s[0]) - 1, lo + int(best[0]))
            new = np.r_[not goes_on, (best[1:] != best[:-1]) | (s[1:] != s[:-1] + 1)]
            before = (lo + int(s[-1]), lo + int(best[-1]))
            heads = np.flatnonzero(new)
            if goes_on:
                runs[-1][-1, 0] += heads[0] if len(heads) else len(s)
            if len(heads):
                firsts.append(s[heads] + lo)
                runs.append(np.stack([np.diff(np.r_[heads, len(s)]), best[heads] - s[heads]], 1).astype(np.uint8))
        if not firsts:
            return np.zeros(0, np.int64), np.zeros((0, 2), np.uint8)
        return np.concatenate(firsts), np.concatenate(runs)


def suffix_order(buf: np.ndarray, n: int) -> np.ndarray:
    """The suffix array of the first ``n`` bytes, by Larsson-Sadakane refinement.

    ``rank`` numbers each group by the place of its first member in ``sa``; only
    groups of more than one suffix are sorted again, by the rank of the suffix
    ``depth`` further on, and the depth doubles.
    """
    first = words(buf, ">")[:n].astype(np.uint64)
    sa = np.argsort(first)
    key = first[sa]
    heads = np.r_[True, key[1:] != key[:-1]] if n else np.zeros(0, bool)
    del first, key
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(heads, np.arange(n, dtype=np.int32), 0))
    depth = 8  # behind the end stand zeros; ties with zeros of the text are broken below
    while True:
        tails = np.r_[heads[1:], True] if n else heads
        open_ = np.flatnonzero(~(heads & tails))
        if not len(open_):
            return sa
        at = sa[open_]
        nxt = at + depth
        beyond = np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + 1, -(nxt - n))  # past the end: the shorter first
        group = rank[at]
        low = int(beyond.min())
        order = np.argsort(group * np.int64(n + 2 - low) + (beyond - low))
        at, group, beyond = at[order], group[order], beyond[order]
        sa[open_] = at
        new = np.r_[True, (group[1:] != group[:-1]) | (beyond[1:] != beyond[:-1])]
        heads[open_] = new
        place = np.maximum.accumulate(np.where(new, open_, 0)).astype(np.int32)
        rank[at] = place
        depth *= 2


def common_prefixes(buf: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each suffix in ``sa`` with the one before it, up to ``cap`` bytes and within the text.

    Kasai: by place in the text, the length falls by one at most from one place to
    the next. So a place's length lies between those of the places ``stride`` before
    and after, less and plus the stride; bytes are compared only where these differ.
    """
    n = len(sa)
    plcp = np.zeros(n + 1, np.int16 if cap < 1 << 14 else np.int64)
    if n < 2:
        return plcp[:n]
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    w = words(buf)

    def extend(i: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        j = phi[i]
        limit = np.minimum(high, np.minimum(cap, n - np.maximum(i, j)))
        length = np.minimum(low, limit).astype(np.int64)
        length[j < 0] = 0
        todo = np.flatnonzero((length < limit) & (j >= 0))
        while len(todo):
            a, b, l = i[todo], j[todo], length[todo]
            diff = w[a + l] ^ w[b + l]
            same = np.where(diff == 0, 8, (np.bitwise_count((diff & (~diff + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.int64))
            length[todo] = np.minimum(l + same, limit[todo])
            todo = todo[(same == 8) & (length[todo] < limit[todo])]
        plcp[i] = length

    stride = 32
    at = np.arange(0, n, stride)
    extend(at, np.zeros(len(at), np.int64), np.full(len(at), cap))
    while stride > 1:
        stride //= 2
        at = np.arange(stride, n, 2 * stride)
        after = at + stride
        high = np.where(after < n, plcp[np.minimum(after, n - 1)] + stride, cap)
        extend(at, np.maximum(plcp[at - stride] - stride, 0), np.minimum(high, cap))
    return plcp[:n][sa]


def window_hash(rec: np.ndarray, width: int) -> np.ndarray:
    """``(rows, span - width + 1)``: a 64-bit hash of every window of ``width`` bytes in each record."""
    prefix = np.zeros((rec.shape[1] + 1, len(rec)), np.uint64)
    for k in range(rec.shape[1]):
        prefix[k + 1] = prefix[k] * _BASE + rec[:, k] + np.uint64(1)
    power = np.uint64(pow(int(_BASE), width, 2**64))
    h = prefix[width:] - prefix[:-width] * power
    h ^= h >> np.uint64(29)
    h *= _MIX[0]
    return (h ^ (h >> np.uint64(32))).T


def row_hash(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        h = h * _BASE + rows[:, k] + np.uint64(1)
    return h ^ (h >> np.uint64(29))


def same_strings(key: np.ndarray, flat: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Class of each string ``flat[at : at + width]``: equal classes, equal bytes. ``key``: its 64-bit hash.

    Keys are found by binary search in the sorted list of all keys; then the
    bytes of each string are compared with its class's first. Strings whose key stands
    for two are told apart by a sort of the bytes themselves.
    """
    listed = np.sort(key)
    listed = listed[np.r_[True, listed[1:] != listed[:-1]]] if len(listed) else listed
    cls = np.searchsorted(listed, key)
    first = np.full(len(listed), -1, np.int64)
    first[cls[::-1]] = at[::-1]
    w, differs = words(flat), np.zeros(len(key), bool)
    for off in sorted({*range(0, width - 7, 8), width - 8}):
        differs |= w[at + off] != w[first[cls] + off]
    if differs.any():
        mixed = np.isin(cls, cls[differs])
        rows = np.flatnonzero(mixed)
        strings = np.stack([flat[at[rows] + k] for k in range(width)], 1).copy().view(f"V{width}")[:, 0]
        ids = {}
        cls[rows] = [len(listed) + ids.setdefault(bytes(s), len(ids)) for s in strings]
    return cls


def merge_strings(rec: np.ndarray, mask: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of anchors with their bytes: bits of the windows that a smaller document has, and of those it is itself first with.

    ``rec`` has the bytes around each anchor, ``mask`` the windows asked about (bit
    o: the window that starts o bytes before the anchor), ``doc`` the document.
    """
    reach = rec.shape[1] - width
    whole = np.concatenate([rec, mask.astype("<u8").view(np.uint8).reshape(-1, 8)], 1)
    flat = np.concatenate([whole.ravel(), np.zeros(8, np.uint8)])
    cls = same_strings(row_hash(whole), flat, np.arange(len(rec)) * whole.shape[1], whole.shape[1])
    _, one, of = np.unique(cls, return_index=True, return_inverse=True)  # equal anchors count once
    low = np.full(len(one), LAST, np.int64)
    np.minimum.at(low, of, doc)
    bits = (mask[one][:, None] >> np.arange(reach + 1, dtype=np.uint64)) & np.uint64(1)
    row, o = np.nonzero(bits)
    start = reach - o
    strings = same_strings(window_hash(rec[one], width)[row, start], flat, one[row] * whole.shape[1] + start, width)
    _, strings = np.unique(strings, return_inverse=True)
    least = np.full(int(strings.max(initial=-1)) + 1, LAST, np.int64)
    np.minimum.at(least, strings, low[row])
    smallest = np.full((len(one), reach + 1), LAST, np.int64)
    smallest[row, o] = least[strings]
    gone = np.zeros(len(rec), np.uint64)
    for k in range(reach + 1):
        gone |= (smallest[of, k] < doc).astype(np.uint64) << np.uint64(k)
    return gone & mask, mask & ~gone


class Shard:
    """A shard's text, documents and anchors, from its row of the shard table."""

    def __init__(self, row: pa.Table, anchoring: Anchoring):
        self.a = anchoring
        text, self.doc, self.length, self.first, run = unpack_arrays(row["data"][0].as_py(), "u1", "<i8", "<i8", "<i8", "u1")
        self.text = text
        self.buf = np.concatenate([text, np.zeros(PAD, np.uint8)])
        self.start = np.cumsum(self.length) - self.length
        run = run.reshape(-1, 2).astype(np.int64)
        self.run, self.anchor = run[:, 0], self.first + run[:, 1]
        self.of = np.searchsorted(self.start, self.first, side="right") - 1  # row of each anchor
        # empty documents share their start with the next: the last one at a start holds the bytes

    def hashes(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and 32-bit key of every anchor."""
        h = self.a.gram_hash(words(self.buf), self.anchor)
        return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), (h & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def digests(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct ``bucket << 32 | key``, each anchor's place in it, and whether two of the shard's documents have it."""
        bucket, key = self.hashes(buckets)
        both, where = np.unique(bucket << 32 | key, return_inverse=True)
        doc = self.doc[self.of]
        low, high = np.full(len(both), LAST, np.int64), np.full(len(both), -LAST, np.int64)
        np.minimum.at(low, where, doc)
        np.maximum.at(high, where, doc)
        return both, where, low != high, np.searchsorted(both >> 32, np.arange(buckets + 1))


def shards(docs: DataFrame, id_col: str, text_col: str, keep: list[str], width: int, shard_bytes: int) -> DataFrame:
    """``shard, data, o``: documents packed into shards, with their anchors and the columns to keep."""
    a = Anchoring(width)
    others = F.struct(*[F.col(f"`{c}`") for c in keep])
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(LAST)).alias("d"), F.col(f"`{text_col}`").alias("t"), others.alias("o"))
    shape = rows.schema["o"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        doc, text, other, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            length = np.array([len(t) for t in text], np.int64)
            buf = padded(b"".join(text))
            text.clear()
            first, runs = a.find(buf, np.cumsum(length) - length, length)
            data = pack_arrays(buf[:-PAD], np.array(doc, "<i8"), length, first, runs)
            kept = pa.ListArray.from_arrays(pa.array([0, len(doc)], pa.int32()), pa.concat_arrays(other))
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | number]), pa.array([data], pa.binary()), kept], ["shard", "data", "o"])

        for batch in batches:
            ids, column, since = batch.column("d").to_pylist(), batch.column("o"), 0
            for i, t in enumerate(batch.column("t")):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                doc.append(ids[i])
                text.append(raw)
                size += len(raw) + 16
                if size >= shard_bytes:
                    other.append(column.slice(since, i + 1 - since))
                    since = i + 1
                    yield out()
                    number, doc, text, other, size = number + 1, [], [], [], 0
            if since < batch.num_rows:  # copied, since a slice would keep the batch with its texts
                other.append(column.take(pa.array(np.arange(since, batch.num_rows))))
        if doc:
            yield out()

    return rows.mapInArrow(run, f"shard bigint, data binary, o array<{shape}>")


def _shared_anchors(table: DataFrame, a: Anchoring, buckets: int) -> DataFrame:
    """``shard, bucket, bits``: which of a shard's distinct anchors in a bucket another document has too."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                both, _, several, cut = Shard(row, a).digests(buckets)
                key = (both & 0xFFFFFFFF).astype("<u4")
                full = np.flatnonzero(cut[1:] > cut[:-1])
                data = [key[cut[b] : cut[b + 1]].tobytes() + np.packbits(several[cut[b] : cut[b + 1]]).tobytes() for b in full]
                n = (cut[full + 1] - cut[full]).astype(np.int32)
                shard = np.full(len(full), row["shard"][0].as_py(), np.int64)
                cols = [pa.array(full.astype(np.int32)), pa.array(shard), pa.array(n), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["bucket", "shard", "n", "keys"])

    def meet(rows: pa.Table) -> pa.Table:
        keys, several = [], []
        for n, blob in zip(rows["n"].to_pylist(), rows["keys"]):
            raw = blob.as_py()
            keys.append(np.frombuffer(raw, "<u4", n))
            several.append(np.unpackbits(np.frombuffer(raw, np.uint8, offset=4 * n), count=n).astype(bool))
        key, flag = np.concatenate(keys), np.concatenate(several)
        order = np.sort(key)
        twice = np.unique(np.concatenate([order[1:][order[1:] == order[:-1]], key[flag]]))
        bits = []
        for k in keys:
            at = np.minimum(np.searchsorted(twice, k), max(len(twice) - 1, 0))
            bits.append(np.packbits(twice[at] == k).tobytes() if len(twice) else np.packbits(np.zeros(len(k), bool)).tobytes())
        return pa.table({"shard": rows["shard"], "bucket": rows["bucket"], "bits": pa.array(bits, pa.binary())})

    sent = table.select("shard", "data").mapInArrow(send, "bucket int, shard bigint, n int, keys binary")
    return sent.groupBy("bucket").applyInArrow(meet, "shard bigint, bucket int, bits binary")


def _pack_strings(bucket: np.ndarray, shard: int, rec, doc, mask, pos, schema) -> pa.RecordBatch:
    order = np.argsort(bucket, kind="stable")
    cuts = np.r_[0, np.flatnonzero(np.diff(bucket[order])) + 1, len(order)] if len(order) else np.zeros(1, np.int64)
    parts = [order[x:y] for x, y in zip(cuts[:-1], cuts[1:])]
    data = [pack_arrays(rec[p], doc[p].astype("<i8"), mask[p].astype("<u8"), pos[p].astype("<i8")) for p in parts]
    cols = [
        pa.array([int(bucket[p[0]]) for p in parts], pa.int32()),
        pa.array([shard] * len(parts), pa.int64()),
        pa.array(data, pa.binary()),
        pa.nulls(len(parts), pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(cols, schema)


_SENT = ["bucket", "shard", "strings", "gone"]
_SENT_SCHEMA = "bucket int, shard bigint, strings binary, gone binary"


def _within_shards(table: DataFrame, shared: DataFrame, a: Anchoring, buckets: int) -> DataFrame:
    """Repeats inside each shard, as ``gone`` (first byte of windows that go), and ``strings`` that other shards must see."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        shard = left["shard"][0].as_py()
        s = Shard(left, a)
        both, where, several, cut = s.digests(buckets)
        known = np.zeros(len(both), bool)
        for b, bits in zip(right["bucket"].to_pylist(), right["bits"]):
            lo, hi = cut[b], cut[b + 1]
            known[lo:hi] = np.unpackbits(np.frombuffer(bits.as_py(), np.uint8), count=hi - lo)
        live = np.flatnonzero(known[where])
        first, run_, anchor, of = s.first[live], s.run[live], s.anchor[live], s.of[live]
        bucket = (both >> 32)[where[live]]
        # every window of an anchor is open, and is settled here where two documents of the shard have the anchor
        mask = ((np.uint64(1) << run_.astype(np.uint64)) - np.uint64(1)) << (anchor - first - run_ + 1).astype(np.uint64)
        here = np.flatnonzero(several[where[live]])
        rep, window, away = _repeats(s, here, first[here], run_[here], s.doc[of[here]], a.width)
        gone = pack_arrays(window[away])
        o = (anchor[rep] - window)[away].astype(np.uint64)
        np.bitwise_and.at(mask, rep[away], ~(np.uint64(1) << o))
        # what is left of each anchor goes on, with just the bytes that its windows hold
        some = np.flatnonzero(mask)
        rec = _records(s.buf, anchor[some], mask[some], a)
        sent = _pack_strings(bucket[some], shard, rec, s.doc[of][some], mask[some], anchor[some], _SENT)
        mine = pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), pa.array([shard]), pa.nulls(1, pa.binary()), pa.array([gone], pa.binary())], _SENT
        )
        return pa.Table.from_batches([mine, sent])

    # all columns, as in the last step: both then read one exchange of the table
    return table.groupBy("shard").cogroup(shared.groupBy("shard")).applyInArrow(run, _SENT_SCHEMA)


def _repeats(s: Shard, anchor: np.ndarray, first: np.ndarray, run: np.ndarray, doc: np.ndarray, width: int):
    """``anchor, window, away`` of the windows of these runs; away: a smaller document of the shard has the window."""
    rep = np.repeat(np.arange(len(run)), run)
    window = np.arange(len(rep)) - np.repeat(np.cumsum(run) - run, run) + first[rep]
    # the text of these windows, side by side
    step = np.zeros(len(s.text) + 1, np.int32)
    np.add.at(step, first, 1)
    np.add.at(step, first + run - 1 + width, -1)
    used = np.cumsum(step[:-1], dtype=np.int32) > 0
    del step
    place = np.cumsum(used, dtype=np.int32) - 1
    text = s.text[used]
    at = place[window]
    del place, used
    buf = np.concatenate([text, np.zeros(PAD, np.uint8)])
    sa = suffix_order(buf, len(text))
    group = np.empty(len(text), np.int32)
    group[sa] = np.cumsum(common_prefixes(buf, sa, width) < width, dtype=np.int32)
    g = group[at]  # windows lie whole in the text, so equal windows have equal g whatever follows them
    low = np.full(int(g.max(initial=-1)) + 1, LAST, np.int64)
    np.minimum.at(low, g, doc[rep])
    return anchor[rep], window, doc[rep] > low[g]


def _records(buf: np.ndarray, anchor: np.ndarray, mask: np.ndarray, a: Anchoring) -> np.ndarray:
    """The bytes around each anchor that its asked windows hold, zeros elsewhere."""
    span = np.arange(a.span) - a.reach
    bits = (mask[:, None] >> np.arange(a.reach + 1, dtype=np.uint64)) & np.uint64(1)
    far = a.reach - np.argmax(bits[:, ::-1], 1)  # the window that starts first, and the one that starts last
    near = np.argmax(bits, 1)
    around = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.zeros(a.reach, np.uint8), buf]), a.span)
    rec = around[anchor]
    rec[(span < -far[:, None]) | (span >= (a.width - near)[:, None])] = 0
    return rec


def _across_shards(sent: DataFrame, a: Anchoring, n_shards: int, merge: int) -> DataFrame:
    """``shard, gone``: first bytes of the windows of each shard that go."""

    def run(rows: pa.Table, last: bool) -> pa.Table:
        bucket = rows["bucket"][0].as_py()
        out = [rows.filter(rows["strings"].is_null()).select(_SENT)]
        rows = rows.filter(rows["strings"].is_valid())
        shard = rows["shard"].to_pylist()
        parts = [unpack_arrays(x.as_py(), "u1", "<i8", "<u8", "<i8") for x in rows["strings"]]
        if parts:
            ends = np.cumsum([len(p[1]) for p in parts])
            rec = np.concatenate([p[0].reshape(-1, a.span) for p in parts])
            doc, mask, pos = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
            gone, left = merge_strings(rec, mask, doc, a.width)
            made = []  # rows of all shards, which are one table: there are as many as shards
            for i, (lo, hi) in enumerate(zip([0, *ends], ends)):
                k, o = np.nonzero((gone[lo:hi, None] >> np.arange(a.reach + 1, dtype=np.uint64)) & np.uint64(1))
                if len(k):
                    made.append((-1, shard[i], None, pack_arrays(pos[lo:hi][k] - o)))
                more = lo + np.flatnonzero(left[lo:hi])
                if len(more) and not last:
                    made.append((bucket, shard[i], pack_arrays(rec[more], doc[more], left[more], pos[more]), None))
            columns = zip(*made) if made else [()] * 4
            types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            out.append(pa.table([pa.array(c, t) for c, t in zip(columns, types)], _SENT))
        return pa.concat_tables(out)

    def level(last: bool):
        return lambda rows: run(rows, last)

    groups = n_shards
    while True:  # the strings still open go on to larger groups of shards
        groups = -(-groups // merge)
        # rows that are settled need no task in common: they keep to their shard's
        key = F.when(F.col("bucket") < 0, F.col("shard")).otherwise(F.pmod(F.xxhash64("shard"), F.lit(groups)))
        met = sent.withColumn("part", key).groupBy("bucket", "part").applyInArrow(level(groups == 1), _SENT_SCHEMA)
        if groups == 1:
            return met.filter("gone is not null").select("shard", "gone")
        sent = met


def _cut(
    docs: DataFrame, id_col: str, text_col: str, keep: list[str], width: int, digest: bool,
    shard_bytes: int | None = None, merge: int | None = None,
) -> DataFrame:
    a = Anchoring(width)
    table = materialize(shards(docs, id_col, text_col, keep, width, shard_bytes or SHARD_BYTES))
    n_shards = max(1, table.count())
    shared = _shared_anchors(table, a, 2 * n_shards)
    sent = _within_shards(table, shared, a, 2 * n_shards)
    gone = _across_shards(sent, a, n_shards, merge or MERGE)
    shape = table.schema["o"].dataType.elementType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        s = Shard(left, a)
        step = np.zeros(len(s.text) + 1, np.int32)
        for blob in right["gone"]:
            (at,) = unpack_arrays(blob.as_py(), "<i8")
            np.add.at(step, at, 1)
            np.add.at(step, at + width, -1)
        covered = np.cumsum(step[:-1]) > 0
        n_removed, n_spans, kept = [], [], []
        for lo, n in zip(s.start.tolist(), s.length.tolist()):
            c = covered[lo : lo + n]
            n_removed.append(int(c.sum()))
            n_spans.append(int(c[:1].sum() + (c[1:] & ~c[:-1]).sum()))
            text = s.text[lo : lo + n][~c].tobytes()
            kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode(errors="ignore"))
        names = ["o", "n_bytes", "n_removed", "n_spans", "kept"]
        cols = [left["o"].combine_chunks().flatten(), pa.array(s.length), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.string())]
        return pa.table(cols, names)

    both = table.groupBy("shard").cogroup(gone.groupBy("shard"))
    out = both.applyInArrow(run, f"o {shape}, n_bytes bigint, n_removed bigint, n_spans bigint, kept string")
    names = free_names([*keep, text_col], "n_bytes", "n_removed", "n_spans")
    counts = [F.col(c).alias(n) for c, n in zip(("n_bytes", "n_removed", "n_spans"), names)]
    text = F.col("kept").alias("kept_sha256" if digest else text_col)
    return out.select(*[F.col("o").getField(c).alias(c) for c in keep], *([*counts, text] if digest else [text, *counts]))


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, **limits) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` per row."""
    return _cut(docs, id_col, text_col, [id_col], width, True, **limits)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, **limits) -> DataFrame:
    """``docs`` with the remaining text and ``n_bytes, n_removed, n_spans``; a character that lost some of its bytes goes whole.

    Where ``docs`` have such a column already, the count's name gets an underscore behind it.
    """
    return _cut(docs, id_col, text_col, [c for c in docs.columns if c != text_col], width, False, **limits)
