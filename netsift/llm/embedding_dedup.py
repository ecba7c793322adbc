"""Embedding near-dedup with robust-pruned flat graphs on overlapping cluster shards.

1. Vectors are scaled to length one in double precision; equal ones of a label form a class and go on once.
2. Each label's classes are cut into overlapping clusters: pivots are a small sample of
   the cluster, thinned so that no two are alike, and a class goes to its ``overlap``
   nearest, but not to one so much farther that no link can reach across; clusters over ``CELL`` classes
   are cut again by pivots of their own. A cluster with few different pivots (or after ``LEVELS`` cuts) is taken as
   one dense lump: its classes are dealt into parts, and every two parts make a shard, so no pair is lost and no
   shard is larger than ``CELL``.
3. Every shard builds a flat graph: nearest and random candidates, robustly pruned, with edges both
   ways. A class's adjacency lists of all its shards are united.
4. Every class is searched in its home shard: greedy beam search from the shard's medoids, then the range
   grows along the edges of everything found above ``EXPAND`` until nothing new comes. Links are pairs whose cosine,
   computed from the vectors, reaches the threshold. They leave the shard as counts and a spanning forest.
5. Recall is audited: the classes of all ids divisible by 100 against all classes of their label, by brute force in
   blocks. A class's recall is the share of its linked classes that were found, whatever their copies; the mean is over classes
   with links. Below ``RECALL`` it starts again with more overlap, up to ``OVERLAPS``. Then the classes at home in a cluster
   whose own mean is below it are compared exactly with all of their label. The recall after that is a column of the result.

Defined results: vectors without a label, that are null, empty, zero, or hold null or non-finite components link with
nothing, nor do vectors of different length; they are components of their own. Rows repeating an id or a vector are
vectors of their own; equal vectors (ties) link with each other. Texts are not read, and a vector may have any
length. A null id never names a component unless there is no other, and is not kept. An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.common import columns_as, materialize
from netsift.llm.components import components

THRESHOLD = 0.98
EXPAND = 0.95
CELL = 1024
#: Most pivots of one cut.
PIVOTS = 128
#: Pivots of a cosine above this are one.
ALIKE = 0.8
LEVELS = 4
#: Rows of a cluster that are dealt to its pivots in one task.
DEAL_ROWS = 20_000
DEGREE, POOL, RANDOM, ALPHA = 24, 48, 16, 1.2
BEAM = 12
RECALL = 0.9
#: Bytes of vectors on each side of two blocks that are compared by brute force.
BLOCK = 8 << 20
OVERLAPS = (2, 4, 8)


def unit_vector(values: list | None) -> np.ndarray | None:
    """Length one in double precision, or None where the vector links with nothing."""
    if not values or None in values:
        return None
    v = np.array(values, np.float64)
    most = np.abs(v).max() if np.isfinite(v).all() else 0.0
    if not most:
        return None
    v = v / most
    return v / np.sqrt(v @ v)


def unit_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, label, unit``: the unit vector's bytes, null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = [unit_vector(x) for x in batch.column("vec").to_pylist()]
            cols = [batch.column("id"), batch.column("label"), pa.array([None if u is None else u.tobytes() for u in unit], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["id", "label", "unit"])

    rows = columns_as(vectors, id=id_col, label=label_col, vec=vector_col)
    types = dict(rows.dtypes)
    out = rows.mapInArrow(run, f"id {types['id']}, label {types['label']}, unit binary")
    return out.withColumn("unit", F.when(F.col("label").isNotNull(), F.col("unit")))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def thinned(x: np.ndarray) -> np.ndarray:
    """Of candidate pivots, those not alike to an earlier one."""
    alike, kept = x @ x.T > ALIKE, []
    for i in range(len(x)):
        if not alike[i, kept].any():
            kept.append(i)
    return x[kept]


_NODE = "cell string, home boolean, dense boolean, rep bigint, unit binary, weight bigint"
_NODE_COLS = [c.split()[0] for c in _NODE.split(", ")]


def clusters(reps: DataFrame, overlap: int, cell_rows: int, threshold: float) -> DataFrame:
    """``cell, home, dense, rep, unit, weight``: each class in its clusters; home is its nearest all the way down."""

    reach = 2 * np.sqrt(2 - 2 * threshold)  # of linked vectors, one's nearest pivot is at most so much farther than the other's own

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        pivots = thinned(matrix(right.sort_by("by")["pivot"])) if right.num_rows else np.zeros((0, 1))
        if len(pivots) < 2 * overlap + 1:
            return left.set_column(left.column_names.index("dense"), "dense", pa.array([True] * left.num_rows)).select(_NODE_COLS)
        near = matrix(left["unit"]) @ pivots.T
        k = min(overlap, len(pivots))
        best = np.argsort(-near, axis=1, kind="stable")[:, :k]
        far = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(near, best, 1)))
        row, rank = np.nonzero(far <= far[:, :1] + reach)
        out = left.select(_NODE_COLS).take(pa.array(row))
        cell = [f"{c}/{p}" for c, p in zip(out["cell"].to_pylist(), best[row, rank].tolist())]
        home = np.asarray(out["home"].to_pylist(), bool) & (rank == 0)
        return out.set_column(0, "cell", pa.array(cell)).set_column(1, "home", pa.array(home))

    dim = F.octet_length("unit")
    now = reps.select(
        F.concat_ws(":", F.col("label").cast("string"), dim.cast("string")).alias("cell"), F.lit(True).alias("home"),
        F.lit(False).alias("dense"), "rep", "unit", "weight",
    )
    settled, wanted = None, F.least(F.lit(PIVOTS), F.ceil(F.col("count") * (3.0 * overlap / cell_rows)))
    for _ in range(LEVELS):
        sizes = now.groupBy("cell").count().filter(F.col("count") > cell_rows)
        sizes = materialize(sizes.select("cell", "count", F.ceil(F.col("count") / DEAL_ROWS).cast("int").alias("salts"), wanted.alias("wanted")))
        if sizes.isEmpty():
            break
        small = now.join(sizes, "cell", "left_anti")
        settled = small if settled is None else settled.unionByName(small)
        large = now.join(sizes, "cell")
        draw = F.pmod(F.xxhash64("rep", "cell"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sample = large.filter(draw < F.col("wanted") / F.col("count"))
        salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
        sample = sample.select(F.col("cell").alias("of"), salt.alias("copy"), F.col("unit").alias("pivot"), F.col("rep").alias("by"))
        dealt = large.withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("salts")).cast("int"))
        dealt = dealt.groupBy("cell", "salt").cogroup(sample.groupBy("of", "copy")).applyInArrow(deal, _NODE)
        dealt = materialize(dealt)
        lumps = dealt.filter("dense")
        settled = settled.unionByName(lumps)
        now = dealt.filter("not dense")
    else:
        now = now.withColumn("dense", F.lit(True))  # parts of these make shards of two each, whatever their size
    return materialize(now if settled is None else settled.unionByName(now))


def shards(nodes: DataFrame, cell_rows: int) -> DataFrame:
    """Add ``shard, part``: a cluster itself, or every two parts of a dense one."""
    sizes = nodes.filter("dense").groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (cell_rows / 2.5)).cast("int").alias("parts"))
    split = nodes.join(sizes, "cell", "left")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("rep"), F.col("parts"))).cast("int")
    split = split.withColumn("part", part)
    mates = F.transform(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1), lambda o: F.concat_ws("-", F.least("part", o), F.greatest("part", o)))
    split = split.withColumn("mate", F.explode(mates))
    return split.withColumn("shard", F.concat_ws("#", "cell", "mate")).drop("parts", "dense", "mate")


def robust_graph(x: np.ndarray) -> np.ndarray:
    """Adjacency of a robust-pruned graph over the rows of ``x``, edges both ways."""
    m = len(x)
    near = x @ x.T
    np.fill_diagonal(near, -np.inf)
    k = min(POOL, m - 1)
    edges = np.zeros((m, m), bool)
    if k < 1:
        return edges
    some = np.random.default_rng(m).integers(0, m, (m, RANDOM))
    pool = np.concatenate([np.argpartition(-near, k - 1, axis=1)[:, :k], some], 1)
    rows = np.arange(m)
    sim = near[rows[:, None], pool]
    far = np.sqrt(np.maximum(0, 2 - 2 * sim))
    alive = np.isfinite(sim)
    for _ in range(DEGREE):
        pick = np.argmax(np.where(alive, sim, -np.inf), 1)
        has = alive[rows, pick]
        if not has.any():
            break
        to = pool[rows, pick]
        edges[rows[has], to[has]] = True
        between = np.sqrt(np.maximum(0, 2 - 2 * np.minimum(near[to[:, None], pool], 1)))
        between[to[:, None] == pool] = 0
        alive &= ALPHA * between > far
    return edges | edges.T


def medoids(x: np.ndarray, n: int = 4) -> np.ndarray:
    """The row nearest the mean, then rows nearest the mean of what is farthest from those taken."""
    taken = [int(np.argmax(x @ x.mean(0)))]
    while len(taken) < min(n, len(x)):
        closest = (x @ x[taken].T).max(1)
        away = x[closest <= np.quantile(closest, 0.5)]
        taken.append(int(np.argmax(x @ away.mean(0))))
    return np.unique(taken)


def search(x: np.ndarray, edges: np.ndarray, queries: np.ndarray, threshold: float) -> np.ndarray:
    """``(queries, rows)``: which rows each query finds at ``threshold`` and above."""
    q, m = x[queries], len(x)
    sim = np.full((len(q), m), -np.inf)
    start = medoids(x)
    sim[:, start] = q @ x[start].T
    expanded = np.zeros(sim.shape, bool)

    def look(new: np.ndarray) -> None:
        r, c = np.nonzero(new)
        for lo in range(0, len(r), 1 << 17):
            a, b = r[lo : lo + (1 << 17)], c[lo : lo + (1 << 17)]
            sim[a, b] = np.einsum("ij,ij->i", q[a], x[b])

    active = np.arange(len(q))
    while len(active):  # greedy: expand the best open row while it is among the BEAM best seen
        here = sim[active]
        open_ = np.where(expanded[active], -np.inf, here)
        best = open_.argmax(1)
        value = open_[np.arange(len(active)), best]
        least = np.partition(here, m - BEAM, axis=1)[:, m - BEAM] if m > BEAM else np.full(len(active), -np.inf)
        go = (value >= least) & np.isfinite(value)
        active, best = active[go], best[go]
        expanded[active, best] = True
        new = np.zeros(sim.shape, bool)
        new[active] = edges[best] & ~np.isfinite(sim[active])
        look(new)
    walk = edges.astype(np.float32)
    while True:  # the range grows from everything near that has not been expanded
        frontier = (sim >= EXPAND) & ~expanded
        rows = np.flatnonzero(frontier.any(1))
        if not len(rows):
            break
        new = np.zeros(sim.shape, bool)
        new[rows] = (frontier[rows].astype(np.float32) @ walk > 0) & ~np.isfinite(sim[rows])
        expanded |= frontier
        look(new)
    found = sim >= threshold
    found[np.arange(len(q)), queries] = False
    return found


def _forest(found: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component, for a symmetric matrix of links."""
    m = len(found)
    label = np.arange(m)
    rows = np.flatnonzero(found.any(1))
    while len(rows):
        low = label.copy()
        for lo in range(0, len(rows), 256):
            r = rows[lo : lo + 256]
            low[r] = np.minimum(label[r], np.where(found[r], label, m).min(1))
        low = low[low]
        if np.array_equal(low, label):
            break
        label = low
    return label


def _links(reps: DataFrame, overlap: int, threshold: float, cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Found links as rows ``rep, root, base, other, links, pairs``, and every class's home as ``rep, base``.

    A row is a share of a class's links (``root`` null) to classes whose home is ``other``, counted with and without copies, or an
    edge of a forest.
    """
    nodes = clusters(reps, overlap, cell_rows, threshold)
    cells = nodes.groupBy("rep").agg(F.collect_list("cell").alias("cells"), F.max(F.when(F.col("home"), F.col("cell"))).alias("base"))
    placed = shards(nodes, cell_rows)

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rep")
        rep = rows["rep"].to_numpy()
        edges = robust_graph(matrix(rows["unit"]))
        return pa.table({"rep": rep, "near": pa.array([rep[e] for e in edges], pa.list_(pa.int64()))})

    lists = placed.groupBy("shard").applyInArrow(build, "rep bigint, near array<bigint>")
    united = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    def find(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rep")
        rep, weight, part = (rows[c].to_numpy() for c in ("rep", "weight", "part"))
        x, m = matrix(rows["unit"]), rows.num_rows
        edges = np.zeros((m, m), bool)
        for i, near in enumerate(rows["near"].to_pylist()):
            at = np.searchsorted(rep, near or [])
            at = at[at < m]
            at = at[np.isin(rep[at], near or [])]
            edges[i, at] = True
        edges |= edges.T
        np.fill_diagonal(edges, False)
        cell, base = rows["cell"][0].as_py(), np.array(rows["base"].to_pylist(), object)
        at_home = base == cell
        found = np.zeros((m, m), bool)
        queries = np.flatnonzero(at_home)
        if len(queries):
            found[queries] = search(x, edges, queries, threshold)
        found |= found.T
        if part.min() != part.max():
            found &= part[:, None] != part  # pairs of one part are found in that part's own shard
        # a link counts for a class in its home; as a guest only if the other is at home here and was never at the guest's home
        names, codes = np.unique(base.astype(str), return_inverse=True)
        known = np.zeros((m, len(names)), bool)
        for i, cs in enumerate(rows["cells"].to_pylist()):
            known[i] = np.isin(names, cs)
        counts = found & (at_home[:, None] | (at_home & ~known[:, codes].T))
        root = _forest(found)
        linked = np.flatnonzero(root != np.arange(m))
        own, to, links, pairs = [], [], [], []
        for c in range(len(names)):
            there = codes == c
            n = counts[:, there].sum(1)
            some = np.flatnonzero(n)
            own.append(some)
            to += [names[c]] * len(some)
            links.append(counts[np.ix_(some, there)] @ weight[there])
            pairs.append(n[some])
        at, none = np.concatenate([*own, linked]), np.zeros(len(linked), np.int64)
        return pa.table({
            "rep": rep[at],
            "root": pa.array([None] * len(to) + rep[root[linked]].tolist(), pa.int64()),
            "base": pa.array(base[at].tolist(), pa.string()),
            "other": pa.array(to + [None] * len(linked), pa.string()),
            "links": pa.array(np.concatenate([*links, none]), pa.int64()),
            "pairs": pa.array(np.concatenate([*pairs, none]), pa.int64()),
        })

    full = placed.join(united, "rep").join(cells, "rep")
    schema = "rep bigint, root bigint, base string, other string, links bigint, pairs bigint"
    return materialize(full.groupBy("shard").applyInArrow(find, schema)), cells.select("rep", "base")


def exact_links(some: DataFrame, reps: DataFrame, threshold: float, edges: bool) -> DataFrame:
    """Every link of ``some`` classes with all ``reps`` of their label, as rows ``rep, root, links, pairs``.

    ``pairs`` is of ``some`` only. With ``edges``, those of forests are given (``root``), and classes of ``reps`` that are
    ``open`` have their links to ``some`` counted as well. Both sides are dealt into blocks of bounded bytes, and every two
    blocks of a label meet.
    """
    dim = F.octet_length("unit").alias("dim")
    blocks = F.ceil(F.sum("dim") / BLOCK).cast("int")
    some = some.select("label", dim, "rep", "unit", "weight")
    reps = reps.select("label", dim, "rep", "unit", "weight", "open")
    sizes = some.groupBy("label", "dim").agg(blocks.alias("n")).join(reps.groupBy("label", "dim").agg(blocks.alias("m")), ["label", "dim"])
    sizes = materialize(sizes)

    def dealt(rows: DataFrame, own: str, count: str, other: str, others: str) -> DataFrame:
        rows = rows.join(sizes, ["label", "dim"]).withColumn(own, F.pmod(F.xxhash64("rep"), F.col(count)).cast("int"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop("n", "m")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]

        def give(rep: np.ndarray, root: np.ndarray, links: np.ndarray, pairs: np.ndarray) -> None:
            for column, values in zip(out, (rep, root, links, pairs)):
                column.append(np.asarray(values, np.int64))

        if left.num_rows and right.num_rows:
            (a, v), (b, w) = ((t[f"rep{e}"].to_numpy(), t[f"weight{e}"].to_numpy()) for t, e in ((left, "_"), (right, "")))
            x, y, open_ = matrix(left["unit_"]), matrix(right["unit"]), np.asarray(right["open"].to_pylist(), bool)
            links, pairs, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            for i in range(0, len(a), CELL):
                for j in range(0, len(b), CELL):
                    p, q = slice(i, i + CELL), slice(j, j + CELL)
                    near = (x[p] @ y[q].T >= threshold) & (a[p, None] != b[q])
                    links[p] += near @ w[q]
                    pairs[p] += near.sum(1)
                    rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
                    if not edges or not len(cols):
                        continue
                    back[q] += v[p] @ near
                    part = near[np.ix_(rows, cols)]
                    square = np.zeros((len(rows) + len(cols),) * 2, bool)
                    square[: len(rows), len(rows) :] = part
                    square |= square.T
                    names, root = np.concatenate([a[p][rows], b[q][cols]]), _forest(square)
                    to = np.flatnonzero(root != np.arange(len(root)))
                    give(names[to], names[root[to]], np.zeros(len(to)), np.zeros(len(to)))
            back[~open_] = 0
            for rep, n, m in ((a, links, pairs), (b, back, np.zeros(len(b)))):
                at = np.flatnonzero(n)
                give(rep[at], np.full(len(at), -1), n[at], m[at])
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        columns[1] = pa.array(columns[1], mask=columns[1] < 0)
        return pa.table(dict(zip(["rep", "root", "links", "pairs"], columns)))

    keys = ["label", "dim", "p", "q"]
    mine, all_ = dealt(some, "p", "n", "q", "m"), dealt(reps, "q", "m", "p", "n")
    mine = mine.select(*[F.col(c).alias(f"{c}_") for c in mine.columns])  # columns of its own, as both sides come of one table
    return mine.groupBy(*[f"{k}_" for k in keys]).cogroup(all_.groupBy(*keys)).applyInArrow(run, "rep bigint, root bigint, links bigint, pairs bigint")


def audit(reps: DataFrame, found: DataFrame, homes: DataFrame, threshold: float) -> DataFrame:
    """``base, n, recall``: by home cluster, the audited classes that have links and the mean of their recall."""
    true = exact_links(reps.filter("asked"), reps.withColumn("open", F.lit(False)), threshold, edges=False)
    true = true.groupBy("rep").agg(F.sum("pairs").alias("true"))
    got = found.filter("root is null").groupBy("rep").agg(F.sum("pairs").alias("got"))
    share = F.least(F.lit(1.0), F.coalesce("got", F.lit(0)) / F.col("true"))
    classes = true.join(got, "rep", "left").join(homes, "rep")
    return materialize(classes.groupBy("base").agg(F.count(F.lit(1)).alias("n"), F.avg(share).alias("recall")))


def mean_recall(audited: DataFrame) -> float:
    """Over all audited classes with links; 1 if there are none."""
    return audited.agg(F.sum(F.col("n") * F.col("recall")) / F.sum("n")).first()[0] or (1.0 if audited.isEmpty() else 0.0)


def completed(found: DataFrame, reps: DataFrame, homes: DataFrame, poor: DataFrame, threshold: float) -> DataFrame:
    """``rep, root, links``, where all links of the classes at home in ``poor`` clusters (``base``) are exact."""
    far = poor.select(F.col("base").alias("other"))
    kept = found.filter("root is null").join(poor, "base", "left_anti").join(far, "other", "left_anti")
    kept = kept.unionByName(found.filter("root is not null")).select("rep", "root", "links")
    marked = reps.join(homes.join(poor, "base", "left_semi").select("rep", F.lit(False).alias("open")), "rep", "left")
    marked = materialize(marked.withColumn("open", F.coalesce("open", F.lit(True))))
    some = marked.filter("not open")
    exact = exact_links(some, marked, threshold, edges=True).select("rep", "root", "links")
    return materialize(kept.unionByName(exact))


def embedding_groups(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, cell_rows: int = CELL,
) -> DataFrame:
    """``id, n_links, component_id, kept, audit_recall`` per row."""
    rows = materialize(unit_rows(vectors, id_col, vector_col, label_col))
    usable = rows.filter("unit is not null")
    asked = F.coalesce(F.max(F.col("id") % 100 == 0), F.lit(False)).alias("asked")
    reps = usable.groupBy("label", "unit").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"), asked)
    reps = materialize(reps.withColumn("rep", F.monotonically_increasing_id()))
    for overlap in OVERLAPS:
        found, homes = _links(reps, overlap, threshold, cell_rows)
        audited = audit(reps, found, homes, threshold)
        recall = mean_recall(audited)
        if recall >= RECALL:
            break
    poor = audited.filter(F.col("recall") < RECALL)
    if not poor.isEmpty():
        found = completed(found, reps, homes, poor.select("base"), threshold)
        recall = mean_recall(audited.withColumn("recall", F.when(F.col("recall") < RECALL, 1.0).otherwise(F.col("recall"))))
    counts = materialize(found.filter("root is null").groupBy("rep").agg(F.sum("links").alias("links")))
    roots = components(found.filter("root is not null").select("rep", "root"), "rep", "root").select(F.col("node").alias("rep"), "root")
    named = reps.join(counts, "rep", "left").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    lowest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    named = named.join(lowest, "root").select("label", "unit", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.join(named, ["label", "unit"], "left")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
        F.lit(float(recall)).alias("audit_recall"),
    )
