"""Phrase collocations from a weighted de Bruijn graph of words.

An edge is a run of four words inside a piece, weighted by its occurrences; it leads from the
node of its first three words to that of its last three.

1. The words of every language are counted. Frequent words get small numbers, the most frequent
   first. A word seen fewer than ``min_count`` times is in no frequent phrase, so it ends a
   piece like a punctuation mark; what remains of the text loses no frequent phrase.
2. Every place of a piece emits its longest run: an edge, or at the last three places of the
   piece the node, pair or word that ends there. Blocks of text add up their own runs first.
   Rows are shuffled by their first two words; pairs of two very frequent words, by the third word too.
3. Sorted by words, each run's rows are together, and so are the rows of everything that
   begins with it. Hence one pass gives the edges' weights and all shorter counts: what flows
   out of a node along its edges, plus the pieces that end there.
4. A node whose one edge in and one edge out both carry all of its flow is inside a unary path.
   Paths are compacted by pointer doubling. Inside them counts are the path's weight, so only
   the other nodes stay in the table of three-word counts, and only they are candidates: a longer
   candidate takes the place of a node inside a path.
5. Candidates of 2 to 4 words are scored at their cuts with the counts of both parts.

Defined results: a null text has no words; a null language is ``und``; null and repeated ids
are of no account, repeated rows count as often as they stand there; ties go by the
order given in ``collocations``. A text of any length is read in blocks that end at a
separator, so what a task holds follows the block's size (and a piece's length). A table that is
empty or without frequent phrases gives no rows. Other columns are ignored.

The numbers of at most ``dictionary`` words are broadcast. If more words than that are frequent, the others keep
62-bit hashes as numbers, which are checked to differ for all words of the corpus.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.llm.common import columns_as, materialize, text_bytes
from netsift.llm.pretokens import slabs
from netsift.session import scratch_path

MIN_COUNT, TOP, COVERED = 30, 2000, 80
DICTIONARY = 400_000
BLOCK = 8 << 20
PART_BYTES = 12 << 20
SALTS = 16
ROWS = 1 << 16
HASHED = 1 << 62
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_SEPARATOR = re.compile(b"[" + re.escape(SEPARATORS) + b"]")
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(SEPARATORS)] = 2
WORDS = ("w1", "w2", "w3", "w4")


def blocks(texts: list[bytes], size: int) -> Iterator[bytes]:
    """The texts with A-Z in lower case, in blocks of about ``size`` bytes that end at a separator."""
    whole, at = b"\n".join(texts).lower(), 0
    while at < len(whole):
        end = _SEPARATOR.search(whole, at + size)
        stop = end.end() if end else len(whole)
        yield whole[at:stop]
        at = stop


def words_of(block: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a block, and the number of separators before each."""
    raw = np.frombuffer(block, np.uint8)
    kind = _KIND[raw]
    word = kind == 0
    edge = np.flatnonzero(np.diff(np.r_[False, word, False]))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[word])])
    return words, np.cumsum(kind == 2, dtype=np.int32)[starts]


def _by_language(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """``language, words, piece numbers`` of blocks of the texts."""

    def rows():
        for batch in batches:
            yield from zip(batch.column("lang").to_pylist(), batch.column("text"))

    for slab in slabs(rows(), lambda x: len(x[1].as_buffer() or b""), size):
        apart: dict[str, list[bytes]] = {}
        for lang, text in slab:
            if text.is_valid:
                apart.setdefault(lang, []).append(text.as_buffer().to_pybytes())
        for lang, texts in apart.items():
            for block in blocks(texts, size):
                yield lang, *words_of(block)


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return columns_as(docs, lang=lang_col, text=text_col).select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def vocabulary(texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """``lang, word, n`` of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, _ in _by_language(batches, block):
            found = words.value_counts()
            for lo in range(0, len(found), ROWS):
                part = found.slice(lo, ROWS)
                cols = [pa.array([lang] * len(part), pa.string()), part.field(0).cast(pa.string()), part.field(1)]
                yield pa.RecordBatch.from_arrays(cols, ["lang", "word", "n"])

    counted = texts.mapInArrow(run, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _hash(lang: str, word: bytes, seed: int) -> int:
    return HASHED | xxhash.xxh3_64_intdigest(lang.encode() + b"\n" + word, seed) >> 2


class Numbers:
    """Numbers of words: the dictionary's by rank; others end a piece, or have a hash where ``seed`` is given."""

    def __init__(self, table: pa.Table, seed: int | None):
        self._seed = seed
        self._of = {}
        for lang in pc.unique(table["lang"]).to_pylist():
            own = table.filter(pc.equal(table["lang"], lang))
            self._of[lang] = (own["word"].combine_chunks().cast(pa.binary()), own["id"].to_numpy())

    def __call__(self, lang: str, words: pa.Array) -> np.ndarray:
        coded = words.dictionary_encode()
        distinct, number = coded.dictionary, np.zeros(len(coded.dictionary), np.int64)
        if lang in self._of:
            known, ids = self._of[lang]
            at = pc.index_in(distinct, value_set=known)
            found = at.is_valid().to_numpy(zero_copy_only=False)
            number[found] = ids[at.drop_null().to_numpy()]
        if self._seed is not None:
            for i in np.flatnonzero(number == 0).tolist():
                number[i] = _hash(lang, distinct[i].as_py(), self._seed)
        return number[coded.indices.to_numpy()]


def runs(number: np.ndarray, piece: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(4, n)`` distinct longest runs of a block's places (0 behind the end), and their counts; in order."""
    cut = np.cumsum(number == 0) + piece  # a word without a number parts those around it
    keep = np.flatnonzero(number)
    number, cut = number[keep], cut[keep]
    n = len(number)
    if not n:
        return
    last = np.flatnonzero(np.r_[cut[1:] != cut[:-1], True])
    left = last[np.searchsorted(last, np.arange(n))] - np.arange(n)  # words behind this one in the piece
    after = np.r_[number, 0, 0, 0]
    grams = np.stack([np.where(left >= k, after[k : n + k], 0) for k in range(4)])
    for lo in range(0, n, 1 << 20):
        part = grams[:, lo : lo + (1 << 20)]
        known, small = np.unique(part, return_inverse=True)  # at most 2 ** 22 of them
        small = small.reshape(part.shape).astype(np.int64)
        pairs, first = np.unique(small[0] << 22 | small[1], return_inverse=True)
        triples, second = np.unique(first.astype(np.int64) << 22 | small[2], return_inverse=True)
        key, count = np.unique(second.astype(np.int64) << 22 | small[3], return_counts=True)
        triple = triples[key >> 22]
        pair = pairs[triple >> 22]
        mask = (1 << 22) - 1
        yield known[np.stack([pair >> 22, pair & mask, triple & mask, key & mask])], count


def edges(texts: DataFrame, numbers: Numbers, block: int = BLOCK) -> DataFrame:
    """``w1, w2, w3, w4, c``: the longest run of every place, counted for each block."""
    shared = texts.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, piece in _by_language(batches, block):
            for grams, count in runs(shared.value(lang, words), piece):
                for lo in range(0, len(count), ROWS):
                    cols = [pa.array(g[lo : lo + ROWS]) for g in grams] + [pa.array(count[lo : lo + ROWS])]
                    yield pa.RecordBatch.from_arrays(cols, [*WORDS, "c"])

    return texts.mapInArrow(run, ", ".join(f"{w} bigint" for w in WORDS) + ", c bigint")


def flows(sent: DataFrame, parts: int, hot: int, min_count: int) -> DataFrame:
    """``size, w1..w4, c``: frequent runs of 2 to 4 words, and shares of the counts of words and of pairs of hot words.

    ``hot``: numbers up to it are of very frequent words; rows of two such words are dealt out by the third.
    """
    salt = F.when((F.col("w1") <= hot) & (F.col("w2") <= hot), F.pmod(F.xxhash64("w3"), F.lit(SALTS))).otherwise(0)
    dealt = sent.repartition(parts, "w1", "w2", salt).sortWithinPartitions(*WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple[np.ndarray, int]] = {}  # of each size, the run that the next batch may go on with

        def done(size: int, words: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
            real = words[size - 1] > 0
            some = real if size == 1 else real & ((c >= min_count) | ((words[0] <= hot) & (words[1] <= hot) if size == 2 else False))
            words, c = words[:, some], c[some]
            cols = [pa.array(np.full(len(c), size, np.int32)), *[pa.array(w) for w in words], pa.array(c)]
            return pa.RecordBatch.from_arrays(cols, ["size", *WORDS, "c"])

        for batch in batches:
            if not batch.num_rows:
                continue
            w = np.stack([batch.column(x).to_numpy() for x in WORDS])
            c, new = batch.column("c").to_numpy(), np.zeros(batch.num_rows, bool)
            new[0] = True
            for size in range(1, 5):
                new[1:] |= w[size - 1][1:] != w[size - 1][:-1]
                heads = np.flatnonzero(new)
                sums, words = np.add.reduceat(c, heads), w[:, heads].copy()
                words[size:] = 0
                if size in open_:
                    before, so_far = open_[size]
                    if (before == words[:, 0]).all():
                        sums[0] += so_far
                    else:
                        words, sums = np.concatenate([before[:, None], words], 1), np.r_[so_far, sums]
                open_[size] = (words[:, -1], int(sums[-1]))
                yield done(size, words[:, :-1], sums[:-1])
        for size, (words, c) in open_.items():
            yield done(size, words[:, None], np.array([c]))

    return dealt.mapInArrow(run, "size int, " + ", ".join(f"{w} bigint" for w in WORDS) + ", c bigint")


def _key(*words: str) -> Column:
    return F.concat_ws(" ", *words)


def compact(edge: DataFrame, node: DataFrame) -> DataFrame:
    """``key, path, place`` of every edge: its unary path, named by the path's first edge, and its place there.

    A node is inside a path where an edge in and an edge out have its whole flow; then it has no others,
    and no piece begins or ends there. A path is finite: the piece that makes its weight begins somewhere.
    """
    full = node.select(F.col("key").alias("at"), F.col("c").alias("flow"))
    ins = edge.select("key", _key("w2", "w3", "w4").alias("at"), "c").join(full, "at").filter("c = flow")
    outs = edge.select("key", _key("w1", "w2", "w3").alias("at"), "c").join(full, "at").filter("c = flow")
    links = outs.select("at", F.col("key").alias("next")).join(ins.select("at", "key"), "at").select(F.col("next").alias("key"), F.col("key").alias("up"))
    at = edge.select("key").join(links, "key", "left")
    at = materialize(at.select("key", F.coalesce("up", "key").alias("path"), F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("bigint").alias("place")))
    while True:
        above = at.select(F.col("key").alias("path"), F.col("path").alias("top"), F.col("place").alias("more"))
        at = materialize(at.drop("more").join(above, "path").select("key", F.col("top").alias("path"), (F.col("place") + F.col("more")).alias("place"), "more"))
        if not at.agg(F.max("more")).first()[0]:
            return at.drop("more")


def _floor_score(a: str, l: str, r: str) -> str:
    return f"(CAST(2000000 AS DECIMAL(18,0)) * CAST({a} AS DECIMAL(19,0))) div CAST(CAST({l} AS DECIMAL(19,0)) + {r} AS DECIMAL(20,0))"


def _counted(
    docs: DataFrame, text_col: str, lang_col: str, min_count: int, dictionary: int, block: int, parts: int | None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``words`` (``id, lang, word, n``), ``totals`` (``lang, total``), and ``found``, the written table of ``flows``."""
    spark = docs.sparkSession
    texts = _texts(docs, text_col, lang_col)
    path = scratch_path(spark, "vocabulary")
    vocabulary(texts, block).write.parquet(path)
    every = spark.read.parquet(path)
    totals = every.groupBy("lang").agg(F.sum("n").alias("total"))
    often = every.filter(F.col("n") >= min_count)
    first = often.orderBy(F.desc("n"), "lang", "word").limit(dictionary).toArrow()  # ``dictionary`` rows at most
    first = first.append_column("id", pa.array(np.arange(1, len(first) + 1)))
    ranked = spark.createDataFrame(first.select(["id", "lang", "word", "n"]))
    seed, words = None, ranked
    if often.count() > len(first):
        seed, hashed = _distinct_hashes(every)
        rest = often.join(ranked.select("lang", "word"), ["lang", "word"], "left_anti").join(hashed, ["lang", "word"])
        words = ranked.unionByName(rest.select("id", "lang", "word", "n"))
    total = sum(r.total for r in totals.collect())  # one row a language
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(text_bytes(texts) / PART_BYTES))
    n = first["n"].to_numpy()
    hot = int(np.searchsorted(-n, -total / (4 * parts), side="right"))
    path = scratch_path(spark, "phrase-flows")
    flows(edges(texts, Numbers(first, seed), block), parts, hot, min_count).write.parquet(path)
    return words, totals, spark.read.parquet(path)


def _distinct_hashes(every: DataFrame) -> tuple[int, DataFrame]:
    """A seed under which all words have different hashes, and ``lang, word, id``."""
    for seed in range(64):
        def run(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = [_hash(x, y.encode(), seed) for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.int64())], ["lang", "word", "id"])

        hashed = every.select("lang", "word").mapInArrow(run, "lang string, word string, id bigint")
        if hashed.groupBy("id").count().filter("count > 1").isEmpty():
            return seed, hashed
    raise RuntimeError("no seed keeps the words' hashes apart")


def graph(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, dictionary: int = DICTIONARY,
          block: int = BLOCK, parts: int | None = None) -> dict[str, DataFrame]:
    """``words``, ``totals``, ``single``, ``pair``, ``node``, ``edge`` (``key, w1.., c`` of frequent runs), ``place`` (see ``compact``)."""
    words, totals, found = _counted(docs, text_col, lang_col, min_count, dictionary, block, parts)

    def of(size: int) -> DataFrame:
        own = WORDS[:size]
        some = found.filter(F.col("size") == size)
        if size <= 2:  # words and pairs of hot words come in shares
            some = some.groupBy(*own).agg(F.sum("c").alias("c")).filter(F.col("c") >= min_count)
        return some.select(_key(*own).alias("key"), *own, "c")

    edge, node = of(4), of(3)
    return {"words": words, "totals": totals, "single": of(1), "pair": of(2), "node": node, "edge": edge, "place": compact(edge, node)}


def paths(g: DataFrame | dict[str, DataFrame], piece: int = 64) -> DataFrame:
    """The compacted paths: ``path, part, c, phrase``; a path longer than ``piece`` edges comes in parts, in order."""
    placed = g["edge"].join(g["place"], "key").withColumn("part", F.expr(f"place div {piece}"))
    # the first edge of a part gives its four words, each further one its last word
    own = F.when(F.col("place") % piece == 0, F.array(*WORDS)).otherwise(F.array("w4"))
    each = placed.select("path", "part", "place", "c", F.posexplode(own).alias("nth", "id")).join(g["words"].select("id", "word", "lang"), "id")
    in_order = F.sort_array(F.collect_list(F.struct("place", "nth", "word")))
    made = each.groupBy("path", "part", "c", "lang").agg(in_order.alias("x"))
    return made.select("lang", "path", "part", "c", F.expr("array_join(transform(x, y -> y.word), ' ')").alias("phrase"))


def candidates(g: dict[str, DataFrame], covered: int = COVERED) -> DataFrame:
    """``key, size, w1..w4, a, l, r, score``: candidates that no longer one covers, with their lowest-scoring cut."""
    inside = g["place"].filter("place > 0").select("key")  # edges whose first node is inside a path
    inner = g["edge"].join(inside, "key").select(_key("w1", "w2", "w3").alias("key"))
    outer = g["node"].join(inner, "key", "left_anti")

    def longest(longer: DataFrame, size: int) -> DataFrame:
        """The largest count of the candidates of one word more that hold a phrase."""
        ends = F.array(_key(*WORDS[:size]), _key(*WORDS[1 : size + 1]))
        return longer.select(F.explode(ends).alias("key"), "c").groupBy("key").agg(F.max("c").alias("most"))

    free = F.coalesce(F.col("most").cast("decimal(20,0)") * 100 < F.col("c").cast("decimal(20,0)") * covered, F.lit(True))
    # what a longer phrase still covers, its part of three words covers as well: one word more is enough
    kept = {2: g["pair"].join(longest(g["node"], 2), "key", "left").filter(free), 3: outer.join(longest(g["edge"], 3), "key", "left").filter(free)}
    rows = None
    for size, some in {**kept, 4: g["edge"]}.items():
        cuts = F.array(*[
            F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), _key(*part).alias("part"))
            for k in range(1, size) for side, part in ((0, WORDS[:k]), (1, WORDS[k:size]))
        ])
        four = [F.col(w) if w in some.columns else F.lit(None).cast("bigint").alias(w) for w in WORDS]
        one = some.select("key", F.lit(size).alias("size"), *four, F.col("c").alias("a"), F.explode(cuts).alias("cut"))
        rows = one if rows is None else rows.unionByName(one)
    counts = g["single"].select("key", "c").unionByName(g["pair"].select("key", "c")).unionByName(outer.select("key", "c"))
    counts = counts.select(F.col("key").alias("part"), F.col("c").alias("f"))
    rows = rows.select("key", "size", *WORDS, "a", "cut.k", "cut.side", "cut.part").join(counts, "part", "left")
    # a part without a row is inside a path: its flow is the path's weight, the edge's own
    rows = rows.withColumn("f", F.coalesce("f", "a"))
    cuts = rows.groupBy("key", "size", *WORDS, "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    best = F.min(F.struct(F.expr(_floor_score("a", "l", "r")).cast("bigint").alias("score"), "k", "l", "r"))
    return cuts.groupBy("key", "size", *WORDS, "a").agg(best.alias("x")).select("key", "size", *WORDS, "a", "x.l", "x.r", "x.score")


def _phrases(some: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with ``lang`` and ``phrase``."""
    each = some.select("*", F.posexplode(F.array(*WORDS)).alias("nth", "id")).filter("id is not null").join(words.select("id", "lang", "word"), "id")
    kept = ["key", "a", "l", "r", "score"]
    in_order = F.sort_array(F.collect_list(F.struct("nth", "word")))  # 4 at most
    made = each.groupBy(*kept, "lang").agg(in_order.alias("x"))
    return made.select("lang", *kept, F.expr("array_join(transform(x, y -> y.word), ' ')").alias("phrase"))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, covered: int = COVERED,
    dictionary: int = DICTIONARY, block: int = BLOCK, parts: int | None = None,
) -> DataFrame:
    """Each language's first ``top`` phrases by score, count (both descending) and text: ``lang, rank, phrase, a, l, r, n, score``."""
    g = graph(docs, text_col, lang_col, min_count, dictionary, block, parts)
    named = _phrases(candidates(g, covered), g["words"])
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within parts of a language, so that no task sees all its candidates
    deal = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = named.withColumn("deal", deal).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order)))
    some = some.filter(F.col("rank") <= top)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    out = some.join(g["totals"], "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
