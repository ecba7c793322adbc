"""Merkle manifest of a table: a digest for every row, one for every source and one for all, with a proof for each row.

1. Every row becomes a leaf digest. Rows are range-partitioned and sorted by
   ``(tree, id, leaf)``, and numbered within their tree from one summary row for each
   partition, so a tree that holds a third of all rows is spread like any other.
2. Levels are built upwards: each run of ``ARITY`` consecutive nodes becomes the
   digest of their concatenated digests, until one node is left. These subroots,
   in the order of their trees, are the leaves of the top tree. Every built node
   is a stored row with its parent, its place there and its children's digests.
3. A recursive query climbs that table from the leaves to the root: each step joins the
   parent, appends the siblings to the proof and folds the (possibly tampered) digests
   with them. The leaves of one run have the same way up, so a run climbs as one row
   with up to ``ARITY`` digests to fold.

Digests are lowercase hex SHA-256 of concatenated inputs, digests as hex text.

Defined results: null values are ``-`` in a leaf; a null tree is a tree of its own,
before all others; a null id stands before all others and is never tampered with; rows
repeating an id are leaves of their own, in the order of their digests; equal rows have equal
leaves and take consecutive places, which of them takes which does not show in the result but for the proof. An empty
text counts as 0 bytes; a text of any length is one input of the leaf's digest. An
empty table gives no rows. Other columns are ignored. DataFrame functions, but for the numbering.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import materialize

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = -1


def field(value: Column) -> Column:
    """A value as an input of a leaf: ``-`` for null, else its UTF-8 byte count, ``:`` and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def fifth(id_: Column) -> Column:
    """The rows whose text is tampered with: 5 divides the crc32 of their decimal id."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame, id_col: str, tree_col: str, text_col: str, fields: Sequence[str], tampered: Callable[[Column], Column]) -> DataFrame:
    """``tree, id, leaf, bent``: each row's digest, and that of the tampered row (null where it is not tampered with)."""
    named = {c: F.col(f"`{c}`") for c in {*fields, id_col, tree_col}}
    bent = {**named, text_col: F.translate(F.col(f"`{text_col}`"), UPPER, LOWER)}
    return docs.select(
        named[tree_col].cast("string").alias("tree"),
        named[id_col].alias("id"),
        leaf_digest([named[c] for c in fields]).alias("leaf"),
        F.when(tampered(named[id_col]), leaf_digest([bent[c] for c in fields])).alias("bent"),
    )


def _changes(batch: pa.RecordBatch) -> np.ndarray:
    """Where a row's tree differs from the row before it in the batch; the first is false."""
    codes = batch.column("tree").dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.r_[False, codes[1:] != codes[:-1]]


def _summaries(rows: DataFrame) -> list:
    """For each partition that has rows: its trees at both ends, their rows there, the number of changes and the longest tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        n = changes = head = tail = longest = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            changed = _changes(batch)
            tree = batch.column("tree")
            if not n:
                first = tree[0].as_py()
            else:
                changed[0] = tree[0].as_py() != last
            last = tree[batch.num_rows - 1].as_py()
            at = np.flatnonzero(changed)
            pieces = np.diff(np.r_[0, at, batch.num_rows])
            if changes == 0:
                head += int(pieces[0])
            tail = int(pieces[-1]) + (0 if len(at) else tail)
            longest = max(longest, int((pieces + np.r_[longest if not changed[0] else 0, np.zeros(len(pieces) - 1, np.int64)]).max()))
            changes += len(at)
            n += batch.num_rows
        if n:
            cols = [[TaskContext.get().partitionId()], [first], [last], [changes], [head], [tail], [longest]]
            types = [pa.int32(), pa.string(), pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["p", "first", "last", "changes", "head", "tail", "longest"])

    schema = "p int, first string, last string, changes bigint, head bigint, tail bigint, longest bigint"
    return sorted(rows.select("tree").mapInArrow(run, schema).collect(), key=lambda r: r.p)  # one row for each partition


def numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int, int]:
    """Rows with ``t, i, last``: their tree's number, their place in it, and whether it is the last; the number of trees; a bound of the largest.

    ``rows`` have a string column ``tree``; ``order`` sorts inside a tree.
    """
    keys = ["tree", *order]
    fixed = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys))
    # what each partition needs to know of those before and behind it
    starts, trees, carry, largest, open_ = {}, 0, 0, 0, None
    found = _summaries(fixed)
    for k, s in enumerate(found):
        goes_on = k > 0 and s.first == open_
        trees += 0 if goes_on else 1
        carry = carry if goes_on else 0
        behind = found[k + 1].first if k + 1 < len(found) else None
        starts[s.p] = (trees - 1, carry, k + 1 < len(found) and behind == s.last)
        trees += s.changes
        largest = max(largest, carry + s.head, s.longest)
        carry = carry + s.head if s.changes == 0 else s.tail
        open_ = s.last
    names = [c for c in rows.columns if c != "tree"]
    schema = ", ".join(["t bigint, i bigint, last boolean", *[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "tree"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, place, goes_on = starts.get(TaskContext.get().partitionId(), (0, 0, False))
        held, begun = None, False  # a batch waits for the next one, whose first row says whether its last tree goes on

        def out(batch: pa.RecordBatch, more: bool) -> pa.RecordBatch:
            nonlocal tree, place
            changed = _changes(batch)
            number = tree + np.cumsum(changed)
            at = np.arange(batch.num_rows)
            since = np.maximum.accumulate(np.where(changed, at, 0))
            i = at - since + np.where(number == tree, place, 0)
            last = np.r_[changed[1:], not more]
            tree, place = int(number[-1]), int(i[-1]) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), pa.array(i, pa.int64()), pa.array(last), *[batch.column(c) for c in names]],
                ["t", "i", "last", *names],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                same = held.column("tree")[held.num_rows - 1].as_py() == batch.column("tree")[0].as_py()
                yield out(held, same)
                if not same:
                    tree, place = tree + 1, 0
            held = batch
        if held is not None:
            yield out(held, goes_on)

    return fixed.mapInArrow(run, schema), trees, largest


def _levels(size: int) -> int:
    n = 0
    while size > 1:
        size, n = -(-size // ARITY), n + 1
    return n


def _node(tree: str, level: str, i: str) -> str:
    return f"concat_ws('.', {tree}, {level}, {i})"


def _parent(n_trees: int, tree: str = "t", level: str = "l", i: str = "i") -> str:
    """SQL of the parent's name: the next level's run; for a tree's last node the top tree's; null for the root."""
    top = f"CASE WHEN {tree} <> {TOP} THEN {_node(str(TOP), '1', f'{tree} div {ARITY}')} END" if n_trees > 1 else "CAST(NULL AS STRING)"
    return f"CASE WHEN {i} = 0 AND last THEN {top} ELSE {_node(tree, f'{level} + 1', f'{i} div {ARITY}')} END"


def _place(tree: str = "t", i: str = "i") -> str:
    return f"CAST(CASE WHEN {i} = 0 AND last THEN {tree} ELSE {i} END % {ARITY} AS INT)"


def _above(nodes: DataFrame, level: int) -> DataFrame:
    """The next level of every tree that still has more than one node."""
    more = nodes.filter("NOT (i = 0 AND last)").withColumn("u", F.expr(f"i div {ARITY}"))
    run = F.sort_array(F.collect_list(F.struct("i", "h")))  # ARITY at most
    met = more.groupBy("t", "u").agg(run.alias("run"), F.max("last").alias("last"))
    made = met.select("t", F.lit(level).alias("l"), F.col("u").alias("i"), "last", F.expr("array_join(transform(run, x -> x.h), '')").alias("kids"))
    return made.withColumn("h", F.sha2("kids", 256))


def _stored(nodes: DataFrame, n_trees: int) -> DataFrame:
    return nodes.selectExpr(
        f"{_node('t', 'l', 'i')} AS node", f"{_parent(n_trees)} AS parent", f"{_place()} AS k", "kids", "h", f"t <> {TOP} AND i = 0 AND last AS sub"
    )


@contextmanager
def _any_number_of_rows(spark: SparkSession):
    """The climb's rows grow with the table; Spark's bound on a recursive query's rows is lifted for it."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


CLIMB = """
WITH RECURSIVE climb(t, u, parent, k, proof, folds, subroot, h) AS (
  SELECT t, u, parent, k, CAST(X'' AS BINARY), folds, subroot, h FROM {runs}
  UNION ALL
  SELECT c.t, c.u, n.parent, n.k,
         concat(c.proof, unhex(left(n.kids, 64 * c.k)), unhex(substr(n.kids, 64 * c.k + 65))),
         transform(c.folds, f -> sha2(concat(left(n.kids, 64 * c.k), f, substr(n.kids, 64 * c.k + 65)), 256)),
         coalesce(c.subroot, CASE WHEN n.sub THEN n.h END), n.h
  FROM climb c JOIN {nodes} n ON n.node = c.parent
)
SELECT t, u, proof, folds, subroot, h AS root FROM climb WHERE parent IS NULL
"""


def build(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "source", text_col: str = "text", fields: Sequence[str] = FIELDS, tampered=fifth):
    """``runs`` (the leaves of each run, with the run's own way up) and ``nodes`` (every built node, linked to its parent)."""
    made = materialize(leaves(docs, id_col, tree_col, text_col, fields, tampered))
    # rows that are equal throughout would meet in one range: their number in the written table spreads them
    made = made.withColumn("tie", F.monotonically_increasing_id())
    rows, n_trees, largest = numbered(made, ["id", "leaf", "tie"])
    member = F.struct("i", "id", "leaf", "bent")
    runs = rows.withColumn("u", F.expr(f"i div {ARITY}")).groupBy("t", "u")
    runs = materialize(runs.agg(F.sort_array(F.collect_list(F.struct("i", member.alias("m")))).alias("run"), F.max("last").alias("last")))
    runs = runs.select("t", "u", "last", F.expr("transform(run, x -> x.m)").alias("members"))
    runs = runs.withColumn("lone", F.expr("u = 0 AND last AND size(members) = 1"))
    runs = runs.withColumn("kids", F.expr("array_join(transform(members, x -> x.leaf), '')"))
    runs = runs.withColumn("h", F.when(F.col("lone"), F.col("kids")).otherwise(F.sha2("kids", 256)))
    level = runs.filter("NOT lone").select("t", F.lit(1).alias("l"), F.col("u").alias("i"), "last", "kids", "h")
    nodes, tops = [level], runs.filter("lone").select("t", "h")
    for n in range(2, _levels(largest) + 1):
        tops = tops.unionByName(level.filter("i = 0 AND last").select("t", "h"))
        level = materialize(_above(level, n))
        nodes.append(level)
    tops = tops.unionByName(level.filter("i = 0 AND last").select("t", "h"))
    level = tops.select(F.lit(TOP).cast("bigint").alias("t"), F.col("t").alias("i"), (F.col("t") == n_trees - 1).alias("last"), "h")
    for n in range(1, _levels(n_trees) + 1):
        level = materialize(_above(level, n))
        nodes.append(level)
    stored = _stored(nodes[0], n_trees)
    for other in nodes[1:]:
        stored = stored.unionByName(_stored(other, n_trees))
    up = {"parent": _parent(n_trees, i="u", level="CASE WHEN lone THEN 0 ELSE 1 END"), "k": _place(i="u")}
    return runs.withColumns({c: F.expr(x) for c, x in up.items()}), materialize(stored)


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "source", text_col: str = "text", fields: Sequence[str] = FIELDS, tampered=fifth) -> DataFrame:
    """Per row: its id, ``leaf, subroot, root, proof_sha256, folded_root, verified``."""
    spark = docs.sparkSession
    runs, nodes = build(docs, id_col, tree_col, text_col, fields, tampered)
    others = "concat(left(kids, 64 * j), substr(kids, 64 * j + 65))"
    folds = f"""CASE WHEN lone THEN transform(members, x -> coalesce(x.bent, x.leaf)) ELSE
      transform(members, (x, j) -> sha2(concat(left(kids, 64 * j), coalesce(x.bent, x.leaf), substr(kids, 64 * j + 65)), 256)) END"""
    below = runs.selectExpr("t", "u", "parent", "k", f"{folds} AS folds", "CASE WHEN u = 0 AND last THEN h END AS subroot", "h")
    with _any_number_of_rows(spark):
        top = materialize(spark.sql(CLIMB, runs=below, nodes=nodes))
    met = runs.select("t", "u", "members", "kids", "lone").join(top, ["t", "u"])
    each = met.select("kids", "lone", "proof", "subroot", "root", F.posexplode(F.arrays_zip("members", "folds")).alias("j", "x"))
    siblings = f"CASE WHEN lone THEN '' ELSE {others} END"
    return each.select(
        F.col("x.members.id").alias(id_col),
        F.col("x.members.leaf").alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.concat(F.expr(siblings), F.lower(F.hex("proof"))), 256).alias("proof_sha256"),
        F.col("x.folds").alias("folded_root"),
        (F.col("x.folds") == F.col("root")).alias("verified"),
    )
