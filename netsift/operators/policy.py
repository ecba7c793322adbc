"""Anonymization policy: which addresses are sensitive.

A policy is text, one rule per line:

* ``A``      a single address (v4 or v6),
* ``A,B``    an inclusive address range, ends in either order,
* ``A/n``    a subnet; for IPv4 only its host addresses (network and broadcast
             address left out, so /31 and /32 hold none) unless
             ``include_edges=True``; for IPv6 the whole prefix.

Rules compile to intervals ``(family, lo, hi)`` of fixed-width hex text (see
``netsift.functions.ipaddr``), overlaps are merged, and membership of a
column is decided by one of four plans:

* ``or``      one boolean expression, an OR of ``BETWEEN`` tests. No join,
              codegen, works on streams. For small policies.
* ``prefix``  intervals cut into aligned prefixes of any length; an equality join
              for each length present, broadcast or shuffled by size (see
              ``netsift.operators.prefixes``). For large policies, however wide.
* ``bucket``  intervals cut into address-prefix buckets and broadcast; an
              equi-join on ``(family, bucket)`` with the range as residual
              condition (BroadcastHashJoin). For many narrow intervals; with
              more than ``MAX_OR_INTERVALS`` wide ones it is the ``prefix`` plan.
* ``range``   a broadcast non-equi join (nested loop); a cross-check only.

A policy is configuration: its size is checked before anything of it is
broadcast or compiled into an expression.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift import schemas
from netsift.functions import ipaddr
from netsift.operators.prefixes import digit_table, mark, prefix_table

V4, V6 = ipaddr.V4, ipaddr.V6
# width in hex digits of an address key and of its join bucket, per family
KEY_WIDTH = {V4: 8, V6: 32}
BUCKET_WIDTH = {V4: 4, V6: 8}  # v4: top 16 bits, v6: top 32 bits
MAX_BUCKETS_PER_INTERVAL = 256
MAX_OR_INTERVALS = 200
# a row is at most 80 characters of hex: some 30 MB of broadcast
MAX_BROADCAST_ROWS = 200_000
MAX_RULES = 5_000_000


def policy_lines(spark: SparkSession, lines: Iterable[str]) -> DataFrame:
    """A policy given inline (a config value) as a one-column DataFrame ``value``."""
    return spark.createDataFrame([(str(x),) for x in lines], "value string")


def compile_rules(rules: DataFrame, *, include_edges: bool = False, column: str = "value") -> DataFrame:
    """Policy text lines -> ``rule, kind, family, lo, hi, empty`` (NULL bounds for a bad rule).

    Built in stages of named columns so that each address conversion appears
    once in the plan.
    """
    t = ipaddr.trim_sql
    df = rules.selectExpr(f"{t(ipaddr.name(column))} AS rule").filter("rule <> ''")
    df = df.selectExpr(
        "rule",
        "CASE WHEN instr(rule, ',') > 0 THEN 'range' WHEN instr(rule, '/') > 0 THEN 'subnet' ELSE 'single' END AS kind",
        t("substring_index(rule, ',', 1)") + " AS _a",
        t("substring_index(substring_index(rule, ',', 2), ',', -1)") + " AS _b",
        t("substring_index(rule, '/', 1)") + " AS _base",
        "try_cast(" + t("substring_index(rule, '/', -1)") + " AS INT) AS _bits",
    )
    first = "CASE WHEN kind = 'subnet' THEN _base ELSE _a END"
    df = df.selectExpr(
        "*",
        f"CASE WHEN {ipaddr.is_v6_sql(first)} THEN {V6} ELSE {V4} END AS family",
        f"{ipaddr.v4_to_hex_sql('_a')} AS _ka4",
        f"{ipaddr.v4_to_hex_sql('_b')} AS _kb4",
        f"{ipaddr.v6_to_hex_sql('_a')} AS _ka6",
        f"{ipaddr.v6_to_hex_sql('_b')} AS _kb6",
        f"{ipaddr.v4_to_long_sql('_base')} AS _n4",
        f"{ipaddr.v6_to_hex_sql('_base')} AS _h6",
    )
    # IPv4 subnet bounds by arithmetic; IPv6 prefix bounds on the 128-bit string
    size = "CAST(pow(2, 32 - _bits) AS BIGINT)"
    net = f"CAST(floor(_n4 / {size}) AS BIGINT) * {size}"
    df = df.selectExpr("*", f"{net} AS _net", f"{net} + {size} - 1 AS _bcast", f"{ipaddr.hex_to_bits_sql('_h6', 32)} AS _b6")
    lo4, hi4 = ("_net", "_bcast") if include_edges else ("_net + 1", "_bcast - 1")
    df = df.selectExpr(
        "*",
        "rpad(substr(_b6, 1, _bits), 128, '0') AS _lob6",
        "rpad(substr(_b6, 1, _bits), 128, '1') AS _hib6",
        f"{lo4} AS _s4lo",
        f"{hi4} AS _s4hi",
    )
    df = df.selectExpr(
        "*",
        f"{ipaddr.bits_to_hex_sql('_lob6', 32)} AS _s6lo",
        f"{ipaddr.bits_to_hex_sql('_hib6', 32)} AS _s6hi",
        f"family = {V4} AND kind = 'subnet' AND _bits BETWEEN 0 AND 32 AND _n4 IS NOT NULL AS _v4sub",
        f"family = {V6} AND kind = 'subnet' AND _bits BETWEEN 0 AND 128 AND _h6 IS NOT NULL AS _v6sub",
    )
    # a host-only IPv4 subnet of /31 or /32 holds no address: an empty rule, not a bad one
    df = df.selectExpr("*", "coalesce(_v4sub AND _s4lo > _s4hi, false) AS empty")

    def bound(pick: str, v4sub: str, v6sub: str) -> str:
        return (
            f"CASE WHEN family = {V4} AND kind = 'single' THEN _ka4 "
            f"WHEN family = {V4} AND kind = 'range' AND _kb4 IS NOT NULL THEN {pick}(_ka4, _kb4) "
            f"WHEN _v4sub AND NOT empty THEN {ipaddr.long_to_hex_sql(v4sub, 8)} "
            f"WHEN family = {V6} AND kind = 'single' THEN _ka6 "
            f"WHEN family = {V6} AND kind = 'range' AND _kb6 IS NOT NULL THEN {pick}(_ka6, _kb6) "
            f"WHEN _v6sub THEN {v6sub} END"
        )

    return df.selectExpr(
        "rule", "kind", "family",
        f"{bound('least', '_s4lo', '_s6lo')} AS lo",
        f"{bound('greatest', '_s4hi', '_s6hi')} AS hi",
        "empty",
    )


@dataclass
class Policy:
    """A compiled policy: merged, disjoint intervals, materialized once.

    ``rows`` holds the intervals on the driver when there are at most
    ``MAX_OR_INTERVALS`` of them (for the OR predicate); ``n`` is their count.
    The bucket table is made once, however many columns are matched.
    """

    intervals: DataFrame
    n: int
    rows: list | None

    @cached_property
    def buckets(self) -> tuple[DataFrame, int]:
        """The bucket table, written once, and its number of rows."""
        table = _checkpointed(bucket_table(self.intervals))
        return table, table.count()

    @cached_property
    def prefixes(self) -> tuple[DataFrame, int, list[int]]:
        """The prefix table in whole digits, written once, its number of rows, and the lengths it has (33 at most)."""
        table = _checkpointed(digit_table(prefix_table(self.intervals)))
        lengths = sorted(r.digits for r in table.select("digits").distinct().collect())
        return table, table.count(), lengths

    @cached_property
    def wide(self) -> list | None:
        """Intervals too wide for buckets, or None where there are too many for an OR."""
        found = wide_intervals(self.intervals)
        return found.collect() if found.count() <= MAX_OR_INTERVALS else None


def _checkpointed(df: DataFrame) -> DataFrame:
    from netsift.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_policy(
    spark: SparkSession,
    path: str | None = None,
    *,
    lines: Iterable[str] | None = None,
    include_edges: bool = False,
    default: bool = False,
    strict: bool = True,
    max_rules: int = MAX_RULES,
    max_or_intervals: int = MAX_OR_INTERVALS,
) -> Policy:
    """Policy file (or inline lines) -> compiled ``Policy``.

    ``default=True`` with no path gives the built-in default policy. A missing
    file is an error (never a silent default). With ``strict`` a rule that
    does not parse raises, since skipping it would leave addresses in clear.
    """
    if path is None and (lines is not None or default):
        # an inline policy is a config value: the same text compiles to the same intervals
        memo_key = (spark.sparkContext.applicationId, id(spark), tuple(lines) if lines is not None else None, include_edges, strict, max_or_intervals)
        if memo_key not in _INLINE_MEMO:
            _INLINE_MEMO[memo_key] = _read_policy(
                spark, None, lines=lines, include_edges=include_edges, default=default, strict=strict,
                max_rules=max_rules, max_or_intervals=max_or_intervals,
            )
        return _INLINE_MEMO[memo_key]
    return _read_policy(spark, path, lines=lines, include_edges=include_edges, default=default, strict=strict,
                        max_rules=max_rules, max_or_intervals=max_or_intervals)


_INLINE_MEMO: dict = {}


def _read_policy(spark, path, *, lines, include_edges, default, strict, max_rules, max_or_intervals) -> Policy:
    if path is not None:
        text = spark.read.text(path)
    elif lines is not None:
        text = policy_lines(spark, lines)
    elif default:
        text = policy_lines(spark, schemas.DEFAULT_POLICY_LINES)
    else:
        raise ValueError("read_policy needs a path, inline lines, or default=True")
    # Computed once and cached: the checks, the merge and the broadcast reuse
    # it, and the cache keeps later filters from being pushed into (and
    # multiplying) the address conversions.
    compiled = compile_rules(text, include_edges=include_edges).persist()
    stats = compiled.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("lo").isNull() & ~F.col("empty"), 1).otherwise(0)).alias("bad"),
    ).first()
    try:
        if stats.n > max_rules:
            raise ValueError(f"policy has {stats.n} rules, more than max_rules={max_rules}")
        if strict and stats.bad:
            bad = compiled.filter(F.col("lo").isNull() & ~F.col("empty")).select("rule").limit(5).collect()
            raise ValueError(f"policy rules that do not parse: {[r.rule for r in bad]}")
        merged = merge_intervals(compiled.filter(F.col("lo").isNotNull()))
        if stats.n - stats.bad <= max_or_intervals:
            # a small policy: at most max_or_intervals rows on the driver
            rows = merged.collect()
            table = spark.createDataFrame(rows, "family int, lo string, hi string")
            return Policy(table, len(rows), rows)
        merged = _checkpointed(merged)
        return Policy(merged, merged.count(), None)
    finally:
        compiled.unpersist()


def merge_intervals(policy: DataFrame) -> DataFrame:
    """Union of overlapping intervals per family (gaps and islands).

    A row starts a new island when its ``lo`` is above every earlier ``hi``.
    Merged intervals are disjoint, so an address matches at most one of them
    and a left join on them never duplicates rows.
    """
    w = Window.partitionBy("family").orderBy("lo", "hi")
    prev_max = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = policy.select("family", "lo", "hi").withColumn(
        "_new", F.when(prev_max.isNull() | (F.col("lo") > prev_max), 1).otherwise(0)
    )
    islands = starts.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("family", "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_island")


def _checked_rows(intervals: DataFrame, limit: int, what: str) -> list:
    n = intervals.count()
    if n > limit:
        raise ValueError(f"{what}: {n} rows exceed the limit {limit}")
    return intervals.collect()


def or_predicate_sql(key: str, family: str, rows) -> str:
    """SQL: OR of ``family = f AND key BETWEEN lo AND hi`` over the given intervals."""
    terms = []
    for r in rows:
        test = f"{key} = '{r.lo}'" if r.lo == r.hi else f"{key} BETWEEN '{r.lo}' AND '{r.hi}'"
        terms.append(f"({family} = {r.family} AND {test})")
    return "coalesce(" + " OR ".join(terms or ["false"]) + ", false)"


def or_predicate(key: str, family: str, rows) -> Column:
    return F.expr(or_predicate_sql(ipaddr.name(key), ipaddr.name(family), rows))


def _bucket_bounds() -> tuple[str, str]:
    width = f"CASE WHEN family = {V6} THEN {BUCKET_WIDTH[V6]} ELSE {BUCKET_WIDTH[V4]} END"
    return (ipaddr.hex_to_long_sql(f"substr(lo, 1, {width})"), ipaddr.hex_to_long_sql(f"substr(hi, 1, {width})"))


def bucket_table(merged: DataFrame) -> DataFrame:
    """Merged intervals cut into prefix buckets: ``family, bucket, lo, hi``.

    Intervals spanning more than MAX_BUCKETS_PER_INTERVAL buckets are left out
    here; ``wide_intervals`` returns them for the OR predicate.
    """
    lo_b, hi_b = _bucket_bounds()
    width = f"CASE WHEN family = {V6} THEN {BUCKET_WIDTH[V6]} ELSE {BUCKET_WIDTH[V4]} END"
    narrow = merged.filter(f"{hi_b} - {lo_b} < {MAX_BUCKETS_PER_INTERVAL}")
    return narrow.selectExpr("family", "lo", "hi", f"explode(sequence({lo_b}, {hi_b})) AS _b").selectExpr(
        "family", f"lower(lpad(hex(_b), {width}, '0')) AS bucket", "lo", "hi"
    )


def wide_intervals(merged: DataFrame) -> DataFrame:
    lo_b, hi_b = _bucket_bounds()
    return merged.filter(f"{hi_b} - {lo_b} >= {MAX_BUCKETS_PER_INTERVAL}")


def covered_addresses(policy: Policy, limit: int) -> DataFrame | None:
    """``family, key`` (hex) of every address that the policy covers; None if there are more than ``limit``.

    The intervals of a small policy are on the driver, where they are counted; its addresses are made in Spark. Intervals
    that differ above the last 60 bits count as too large.
    """
    low, n = 15, 0
    for r in policy.rows if policy.rows is not None else ():
        n += int(r.hi, 16) - int(r.lo, 16) + 1
        if r.hi[:-low] != r.lo[:-low]:
            return None
    if policy.rows is None or n > limit:
        return None
    start, end = (ipaddr.hex_to_long_sql(f"right({x}, least({low}, length({x})))") for x in ("lo", "hi"))
    each = policy.intervals.selectExpr("family", f"left(lo, greatest(length(lo) - {low}, 0)) AS above", "length(lo) AS width", f"explode(sequence({start}, {end})) AS n")
    return each.selectExpr("family", "concat(above, lower(lpad(hex(n), width - length(above), '0'))) AS key")


def address_key(df: DataFrame, column: str, prefix: str = "_") -> DataFrame:
    """Add ``{prefix}{column}_fam`` and ``{prefix}{column}_key`` (hex) for an address column."""
    fam = ipaddr.ip_family(column)
    key = ipaddr.ip_key(column)
    return df.withColumns({f"{prefix}{column}_fam": fam, f"{prefix}{column}_key": key})


def match_policy(
    df: DataFrame,
    column: str,
    policy: Policy,
    *,
    plan: str = "auto",
    out: str | None = None,
    max_or_intervals: int = MAX_OR_INTERVALS,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add boolean ``out`` (default ``{column}_sensitive``): is the cell's address in the policy.

    Cells that are not addresses are not sensitive. Rows are never added or
    dropped, whatever the plan.
    """
    out = out or f"{column}_sensitive"
    intervals = policy.intervals
    keyed = address_key(df, column)
    fam, key = F.col(f"_{column}_fam"), F.col(f"_{column}_key")
    if plan == "auto":
        plan = "or" if policy.rows is not None and policy.n <= max_or_intervals else "prefix"
    if plan == "bucket" and policy.wide is None:
        plan = "prefix"
    if plan == "or":
        rows = policy.rows if policy.rows is not None else _checked_rows(intervals, max_or_intervals, "policy intervals")
        result = keyed.withColumn(out, or_predicate(f"_{column}_key", f"_{column}_fam", rows))
    elif plan == "prefix":
        table, n, lengths = policy.prefixes
        result = mark(keyed, fam, key, table, lengths, out, broadcast=n <= max_broadcast_rows)
    elif plan == "bucket":
        wide = policy.wide
        buckets, n = policy.buckets
        b = buckets.select(
            F.col("family").alias("_pf"), F.col("bucket").alias("_pb"), F.col("lo").alias("_plo"), F.col("hi").alias("_phi")
        )
        width = F.when(fam == V6, BUCKET_WIDTH[V6]).otherwise(BUCKET_WIDTH[V4])
        keyed = keyed.withColumn(f"_{column}_bucket", key.substr(F.lit(1), width))
        # over the limit: a shuffle join on family and bucket, with the same result
        joined = keyed.join(
            F.broadcast(b) if n <= max_broadcast_rows else b.hint("merge"),
            (fam == F.col("_pf")) & (F.col(f"_{column}_bucket") == F.col("_pb")) & key.between(F.col("_plo"), F.col("_phi")),
            "left",
        )
        hit = F.col("_plo").isNotNull() | or_predicate(f"_{column}_key", f"_{column}_fam", wide)
        result = joined.withColumn(out, hit).drop("_pf", "_pb", "_plo", "_phi", f"_{column}_bucket")
    elif plan == "range":
        if policy.n > max_broadcast_rows:
            raise ValueError(f"policy has {policy.n} intervals, above max_broadcast_rows={max_broadcast_rows}")
        p = intervals.select(F.col("family").alias("_pf"), F.col("lo").alias("_plo"), F.col("hi").alias("_phi"))
        joined = keyed.join(F.broadcast(p), (fam == F.col("_pf")) & key.between(F.col("_plo"), F.col("_phi")), "left")
        result = joined.withColumn(out, F.col("_plo").isNotNull()).drop("_pf", "_plo", "_phi")
    else:
        raise ValueError(f"unknown plan {plan!r}")
    return result.drop(f"_{column}_fam", f"_{column}_key")
