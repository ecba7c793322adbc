"""Best-fit packing of documents into token sequences after Martello-Toth reduction.

Pieces are at most ``capacity`` tokens long, so a packing instance is the count
of pieces of each length: a table of ``capacity`` rows however many documents
there are. The driver solves that table only. The reduction permanently fixes
sets of one, two or three lengths that dominate every other set holding the
same longest piece, as often as the counts allow, until nothing more can be
fixed; best fit in decreasing order packs the rest. The answer is a list of
patterns with multiplicities. Spark numbers the pieces of each length (within
salted groups, then by the groups' running counts) and every piece looks up its
sequence and offset from its length and number.

Defined results: an added token of the vocabulary standing in a text has its own id, as
``tokenizers`` gives it; a null or empty text is a document of the end id alone; rows
repeating an id are documents of their own; a very long text is encoded whole and cut;
pieces of one length (ties) are alike for the packing, and any of them may take a place;
an empty table gives no pieces.
Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsift.llm.byte_bpe import read_ranks
from netsift.llm.common import columns_as, materialize
from netsift.llm.pretokens import slabs

SLAB = 4 << 20
WITNESS = 1 << 16
#: Pieces numbered together within one length.
GROUP_ROWS = 100_000

Pattern = tuple[int, tuple[int, ...]]  # how many sequences, the lengths in each


class TokenEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes; nothing is put around a text.

    The vocabulary is the ``tokenizers`` file's; the ids come from its rank file
    through ``tiktoken``, which takes a quarter of the CPU time for the same ids.
    One text of every slab is encoded by ``tokenizers`` too, and a difference raises.
    A text that ``tiktoken`` cannot match (white space of some million characters) is encoded by ``tokenizers`` whole.

    ``added``: strings that the file registers as added tokens have their one id, as
    ``tokenizers`` gives it; else they are ordinary text.
    """

    def __init__(self, path: str, ranks_path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self._reference = Tokenizer.from_file(path)
        self._reference.encode_special_tokens = not added
        tokens = self._reference.get_added_tokens_decoder() if added else {}
        # one that is matched as it stands; others meet rules that only tokenizers has
        plain = len(tokens) < 2 and not any(t.single_word or t.lstrip or t.rstrip for t in tokens.values())
        special = {t.content: i for i, t in tokens.items()} if plain else {}
        self._whole = [] if plain else [t.content for t in tokens.values()]
        ranks = read_ranks(ranks_path)
        self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def _by_reference(self, text: str) -> bytes:
        return np.array(self._reference.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _ids(self, text: str) -> bytes:
        if any(x in text for x in self._whole):
            return self._by_reference(text)
        try:
            return self._fast.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4", copy=False).tobytes()
        except ValueError:  # the pattern's stack is bounded
            return self._by_reference(text)

    @staticmethod
    def witness(texts: list[str]) -> int:
        """The text that is encoded by ``tokenizers`` as well: any but an empty one, by a hash, of those up to ``WITNESS``
        characters; the shortest where all are longer, since its encodings are large."""
        return min(range(len(texts)), key=lambda i: (not texts[i], max(len(texts[i]), WITNESS), zlib.crc32(texts[i].encode())))

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [self._ids(t) for t in texts]
        k = self.witness(texts)
        if self._by_reference(texts[k]) != out[k]:
            raise ValueError("the rank file does not give the tokenizer's ids")
        return out


@lru_cache(maxsize=2)
def token_encoder(path: str | None = None, ranks_path: str | None = None, added: bool = False) -> TokenEncoder:
    """Once per Python worker; None: the public 50k vocabulary of the worker's machine."""
    import public_tokenizers as p

    return TokenEncoder(path or p.path("byte_bpe_50k.json"), ranks_path or p.path("byte_bpe_50k.tiktoken"), added)


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids; only the first may be short."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return ([(0, first)] if first else []) + [(s, capacity) for s in range(first, n, capacity)]


def cut_documents(
    docs: DataFrame, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    path: str | None = None, ranks_path: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """Tokenize whole texts, append ``end_id`` and cut: ``id, piece, start, length, ids_crc32[, ids]``."""
    end = int(end_id).to_bytes(4, "little")
    schema = f"id {dict(docs.dtypes)[id_col]}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_encoder(path, ranks_path, added=True)
        for batch in batches:
            rows = zip(range(batch.num_rows), batch.column(1))
            for slab in slabs(((i, t.as_py() or "") for i, t in rows), lambda x: len(x[1]), SLAB):
                at, found = [], []
                for (i, _), ids in zip(slab, encoder.encode([t for _, t in slab])):
                    ids += end
                    for k, (s, n) in enumerate(pieces_of(len(ids) // 4, capacity)):
                        part = ids[4 * s : 4 * (s + n)]
                        at.append(i)
                        found.append((k, s, n, zlib.crc32(part), part))
                k, s, n, crc, part = zip(*found)
                cols = [batch.column(0).take(pa.array(at)), pa.array(k, pa.int32()), pa.array(s), pa.array(n), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(p, "<i4") for p in part], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in schema.split(", ")])

    return columns_as(docs, id=id_col, text=text_col).mapInArrow(run, schema)


def reduce_instance(counts: list[int], capacity: int) -> list[Pattern]:
    """Fix dominating sets; ``counts`` (by length, index 0 unused) is lowered in place.

    With j the longest piece not yet settled and k the longest that fits beside it:
    j alone dominates if nothing fits beside it; {j, k} if they fill the
    sequence, or if no two pieces fit beside j, or if no three do and k is as long
    as the best two together; {j, k, b} if no three fit beside j and b, the longest
    beside j and k, is as long as the shorter of any two that fit beside j.
    """
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while counts[j]:
                found = _dominating(counts, j, capacity)
                if found is None:
                    break
                times = min(counts[x] // found.count(x) for x in set(found))
                for x in found:
                    counts[x] -= times
                fixed.append((times, found))
                changed = True
    return fixed


def _dominating(counts: list[int], j: int, capacity: int) -> tuple[int, ...] | None:
    counts[j] -= 1
    try:
        room = capacity - j
        k = _longest(counts, room)
        if not k:
            return (j,)
        if k == room:
            return (j, k)
        small = _smallest(counts, 3)
        if len(small) < 2 or small[0] + small[1] > room:
            return (j, k)
        if len(small) == 3 and sum(small) <= room:
            return None
        best, second = 0, 0  # the fullest two beside j; the longest shorter one of any two
        for x in range(min(k, room - 1), 0, -1):
            if counts[x]:
                counts[x] -= 1
                y = _longest(counts, min(room - x, x))
                counts[x] += 1
                if y:
                    best, second = max(best, x + y), max(second, y)
        if k >= best:
            return (j, k)
        counts[k] -= 1
        b = _longest(counts, room - k)
        counts[k] += 1
        return (j, k, b) if b and b >= second else None
    finally:
        counts[j] += 1


def _longest(counts: list[int], most: int) -> int:
    for x in range(min(most, len(counts) - 1), 0, -1):
        if counts[x]:
            return x
    return 0


def _smallest(counts: list[int], n: int) -> list[int]:
    out: list[int] = []
    for x in range(1, len(counts)):
        out += [x] * min(counts[x], n - len(out))
        if len(out) == n:
            break
    return out


def best_fit(counts: list[int], capacity: int) -> list[Pattern]:
    """Best fit in decreasing order over counts: equal pieces go to equal sequences together."""
    by_room: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    for size in range(capacity, 0, -1):
        left = counts[size]
        while left:
            room = next((r for r in range(size, capacity + 1) if by_room[r]), 0)
            if room:
                times, held = by_room[room].pop()
                used = min(times, left)
                if times > used:
                    by_room[room].append((times - used, held))
                by_room[room - size].append((used, (*held, size)))
                left -= used
            else:
                each = min(capacity // size, left)
                used = left // each
                by_room[capacity - each * size].append((used, (size,) * each))
                left -= used * each
    return [p for patterns in by_room for p in patterns]


def pack_lengths(counts: list[int], capacity: int) -> list[Pattern]:
    """Patterns that hold every piece counted (``counts[length]``)."""
    left = list(counts)
    fixed = reduce_instance(left, capacity)
    return fixed + best_fit(left, capacity)


def placements(patterns: list[Pattern], capacity: int) -> dict[int, list[np.ndarray]]:
    """By length, arrays of ``first number, first sequence, offset``: a pattern's share of that length."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    used, base = [0] * (capacity + 1), 0
    for times, held in patterns:
        offset = 0
        for x in held:
            rows.setdefault(x, []).append((used[x], base, offset))
            used[x] += times
            offset += x
        base += times
    return {x: [np.array(c, np.int64) for c in zip(*r)] for x, r in rows.items()}


def number_within_length(pieces: DataFrame, n_pieces: int) -> DataFrame:
    """Add ``nth``, from 0 within a length. A length may hold any share of the rows: groups are salted."""
    salts = max(1, n_pieces // GROUP_ROWS)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(salts)).cast("int"))
    per = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    within = Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32")
    ranked = salted.withColumn("within", F.row_number().over(within) - 1)
    starts = per.select("length", "salt", before.alias("before"))
    return ranked.join(starts, ["length", "salt"]).withColumn("nth", F.col("within") + F.col("before")).drop("salt", "within", "before")


def pack_documents(
    docs: DataFrame, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    path: str | None = None, ranks_path: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``id, piece, start, length, ids_crc32[, ids], sequence_id, offset``."""
    pieces = materialize(cut_documents(docs, capacity, end_id, id_col, text_col, path, ranks_path, with_ids))
    counts = [0] * (capacity + 1)
    for r in pieces.groupBy("length").count().collect():  # capacity rows at most
        counts[r["length"]] = r["count"]
    where = placements(pack_lengths(counts, capacity), capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            nth = batch.column("nth").to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                first, base, offset = where[int(length[rows[0]])]
                at = np.searchsorted(first, nth[rows], side="right") - 1
                seq[rows] = base[at] + nth[rows] - first[at]
                off[rows] = offset[at]
            cols = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    numbered = number_within_length(pieces, sum(counts)).select(*names, "nth")
    schema = ", ".join(f"{c} {t}" for c, t in numbered.select(names).dtypes) + ", sequence_id bigint, offset bigint"
    return numbered.mapInArrow(place, schema).withColumnRenamed("id", id_col)


def lower_bound(counts: list[int], capacity: int) -> int:
    """Sequences that no packing can do without: Martello and Toth's bound L2 on counts."""
    best = 0
    for k in range(capacity // 2 + 1):
        alone = sum(counts[capacity - k + 1 :])
        large = range(capacity // 2 + 1, capacity - k + 1)
        n, held = sum(counts[x] for x in large), sum(x * counts[x] for x in large)
        rest = sum(x * counts[x] for x in range(max(k, 1), capacity // 2 + 1))
        best = max(best, alone + n + max(0, -(-(rest - (n * capacity - held)) // capacity)))
    return best
