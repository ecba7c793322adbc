"""Byte-level BPE by padded numpy matrices, and its decoding.

Pre-tokens of similar length share one matrix of token ids, a row each. In
every round each row merges its leftmost pair of minimum rank; ranks of pairs
come from an open-addressing hash table in numpy. A merge closes the gap it
leaves, and rows with no pair left are moved out of the matrix. Pre-tokens over
``LONG`` bytes (rounds would cost their square) go through a heap of pairs with
the same order of merges.

Texts are matched and encoded whole, very long ones too; a null text is empty and has no ids. Decoding joins
the bytes of the ids. Of pairs with the same rank (ties) the leftmost merges first; repeated rows are encoded
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from netsift.llm.common import columns_as
from netsift.llm.pretokens import PreTokenEncoder, slabs

NONE = np.int32(2**31 - 1)
LONG = 256
SLAB = 4 << 20


class PairTable:
    """Hashed lookup ``(left id, right id) -> id of the merged token``; NONE where there is none."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self._bits = max(4, (4 * len(keys) + 1).bit_length())
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._values = np.full(1 << self._bits, NONE, np.int32)
        left, val = np.array(keys, np.int64), np.array(values, np.int32)
        at = self._home(left)
        while len(left):  # one claim a slot and round; the others try the next slot
            _, first = np.unique(at, return_index=True)
            free = first[self._keys[at[first]] == -1]
            self._keys[at[free]], self._values[at[free]] = left[free], val[free]
            rest = np.ones(len(left), bool)
            rest[free] = False
            left, val, at = left[rest], val[rest], (at[rest] + 1) & (len(self._keys) - 1)

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        flat = np.ascontiguousarray(key).ravel()
        at = self._home(flat)
        held = self._keys[at]
        out = np.where(held == flat, self._values[at], NONE)
        open_ = np.flatnonzero((held != flat) & (held != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self._keys) - 1)
            held = self._keys[at[open_]]
            hit = held == flat[open_]
            out[open_[hit]] = self._values[at[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out.reshape(key.shape)


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self._byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self._pair = PairTable(ranks)
        self.token = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.token[r] = t

    def encode_many(self, tokens: list[str]) -> list[bytes]:
        """Ids of each pre-token as little-endian unsigned 32-bit bytes."""
        raw = [t.encode() for t in tokens]
        whole = list(map(self.ranks.get, raw))
        out = [b"" if r is None else r.to_bytes(4, "little") for r in whole]
        rest = [i for i, r in enumerate(whole) if r is None]
        n = np.fromiter((len(raw[i]) for i in rest), np.int64, len(rest))
        for k in np.flatnonzero(n > LONG):
            out[rest[k]] = np.array(self._long(raw[rest[k]]), "<u4").tobytes()
        order = np.argsort(n, kind="stable")
        order = order[: int(np.searchsorted(n[order], LONG, side="right"))]
        widths = (n[order] + 3) // 4 * 4
        lo = 0
        while lo < len(order):  # rows of one padded width, so many that the matrix stays small
            width = int(widths[lo])
            hi = min(int(np.searchsorted(widths, width, side="right")), lo + max(1, (1 << 18) // width))
            rows = [rest[k] for k in order[lo:hi]]
            for i, ids in zip(rows, self._matrix(b"".join([raw[i] for i in rows]), n[order[lo:hi]], width)):
                out[i] = ids
            lo = hi
        return out

    def _matrix(self, joined: bytes, n: np.ndarray, width: int) -> list[bytes]:
        text = np.zeros((len(n), width), np.uint8)
        text[np.arange(width) < n[:, None]] = np.frombuffer(joined, np.uint8)
        ids = self._byte[text]
        rank = self._pair(ids[:, :-1], ids[:, 1:])
        rank[np.arange(width - 1) >= (n - 1)[:, None]] = NONE
        done, length, who = np.zeros_like(ids), n.copy(), np.arange(len(n))
        while len(ids):
            row = np.arange(len(ids))
            j = rank.argmin(axis=1)  # the first of equal ranks: the leftmost
            best = rank[row, j]
            live = best != NONE
            if not live.all():
                ended = who[~live]
                done[ended, :width] = ids[~live]
                length[ended] = n[~live]
                ids, rank, n, who, j, best = ids[live], rank[live], n[live], who[live], j[live], best[live]
                row = np.arange(len(ids))
                if not len(ids):
                    break
                width = int(n.max())
                ids, rank = ids[:, :width], rank[:, : width - 1]
            cols = np.arange(width)
            step = cols > j[:, None]
            ids = np.take_along_axis(ids, np.minimum(cols + step, width - 1), 1)
            ids[row, j] = best
            n = n - 1
            rank = np.take_along_axis(rank, np.minimum((cols + step)[:, :-1], width - 2), 1)
            rank[:, -1] = NONE
            for side in (j - 1, j):
                ok = (side >= 0) & (side < n - 1)
                r, c = row[ok], side[ok]
                rank[r, c] = self._pair(ids[r, c], ids[r, c + 1])
            over = (j >= n - 1) & (j < width - 1)
            rank[row[over], j[over]] = NONE
        flat = done[np.arange(done.shape[1]) < length[:, None]].astype("<u4").tobytes()
        ends = np.cumsum(4 * length).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _long(self, raw: bytes) -> list[int]:
        pairs = self._pairs()
        ids = self._byte[np.frombuffer(raw, np.uint8)].tolist()
        nxt, prev, dead = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), bytearray(len(ids))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            k = nxt[i]
            if dead[i] or k >= len(ids) or ids[i] != a or ids[k] != b:
                continue
            ids[i], dead[k], nxt[i] = r, 1, nxt[k]
            if nxt[i] < len(ids):
                prev[nxt[i]] = i
                if (q := pairs.get((r, ids[nxt[i]]))) is not None:
                    heapq.heappush(heap, (q, i, r, ids[nxt[i]]))
            if prev[i] >= 0 and (q := pairs.get((ids[prev[i]], r))) is not None:
                heapq.heappush(heap, (q, prev[i], ids[prev[i]], r))
        return [x for x, d in zip(ids, dead) if not d]

    @lru_cache(maxsize=1)  # noqa: B019  one codec lives as long as its worker
    def _pairs(self) -> dict[tuple[int, int], int]:
        used = self._pair._keys >= 0
        keys, values = self._pair._keys[used].tolist(), self._pair._values[used].tolist()
        return {(k >> 32, k & 0xFFFFFFFF): v for k, v in zip(keys, values)}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def codec(path: str | None = None) -> tuple[ByteBPE, PreTokenEncoder]:
    """The codec of a rank file, once per Python worker; None: the public 50k vocabulary of the worker's machine."""
    import public_tokenizers

    bpe = ByteBPE(read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return bpe, PreTokenEncoder(public_tokenizers.PATTERN, bpe.encode_many)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id, ids array<int>, decoded binary`` per row: the real token ids and the bytes they decode to.

    Defined results: a null or empty text has no ids and decodes to nothing; a
    null id stays null; repeated rows are encoded each. Other columns are ignored.
    """
    return _map(docs, id_col, text_col, path, f"`{id_col}` {dict(docs.dtypes)[id_col]}, ids array<int>, decoded binary", False)


def encode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Like ``encode_documents`` with digests in place of ids and bytes: ``id, n_tokens, ids_sha256, decoded_sha256``."""
    kind = dict(docs.dtypes)[id_col]
    return _map(docs, id_col, text_col, path, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", True)


def _map(docs: DataFrame, id_col: str, text_col: str, path: str | None, schema: str, digests: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, units = codec(path)
        for batch in batches:
            rows = zip(range(batch.num_rows), batch.column(1))
            for slab in slabs(((i, t.as_py() or "") for i, t in rows), lambda x: len(x[1]), SLAB):
                ids = units.encode([t for _, t in slab])
                key = batch.column(0).slice(slab[0][0], len(slab))
                back = [bpe.decode(x) for x in ids]
                if digests:
                    cols = [
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(x).hexdigest() for x in back]),
                    ]
                    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    cols = [pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())), pa.array(back, pa.binary())]
                    names = [id_col, "ids", "decoded"]
                yield pa.RecordBatch.from_arrays([key, *cols], names)

    return columns_as(docs, id=id_col, text=text_col).mapInArrow(run, schema)
