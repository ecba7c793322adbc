"""Address intervals as aligned prefixes, and membership by equality of prefixes (M8).

An aligned prefix stands for all addresses that begin with its bits. Every
interval has a least set of prefixes that are together just the interval: at
most 62 of them for IPv4 and 254 for IPv6, however wide it is. Merged
intervals are disjoint, so an address begins with at most one prefix of a policy.

For the join, prefixes are lengthened to whole hex digits (one becomes at most
eight), so the join key of an address is a substring of its fixed-width hex
text. There is one equality join for each number of digits that the policy has,
at most 33, and no range condition. Under the row limit the joins are
broadcast; beyond it the distinct addresses are matched by a shuffle join
and the hits joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions import ipaddr

V4, V6 = ipaddr.V4, ipaddr.V6
BITS = {V4: 32, V6: 128}
_NONE = "CAST(array() AS ARRAY<STRING>)"


def least_prefixes_sql(lo: str, hi: str, width: int) -> str:
    """SQL: the least set of bit prefixes of the interval between two bit strings of ``width``, in order.

    Below the first bit in which the ends differ, the lower half is what starts at
    ``lo`` (its last zeros left off) and, for every zero before them, the sibling to its right; the
    upper half mirrors that with the ones of ``hi``. Halves that are both whole are one prefix.
    """
    j, k, m = ipaddr.fresh("j"), ipaddr.fresh("k"), ipaddr.fresh("m")

    def cut(e):  # lo, hi, place of the first difference (0: none)
        a, b, q = (f"{e}.{x}" for x in "abq")

        def halves(t):  # last zeros of lo, last ones of hi, below that place
            z, o = f"{t}.z", f"{t}.o"
            right = f"transform(filter(sequence({q} + 1, {width} - {z}), {k} -> substr({a}, {k}, 1) = '0'), {k} -> concat(substr({a}, 1, {k} - 1), '1'))"
            left = f"transform(filter(sequence({q} + 1, {width} - {o}), {m} -> substr({b}, {m}, 1) = '1'), {m} -> concat(substr({b}, 1, {m} - 1), '0'))"
            # the siblings right of lo come out from the widest to the narrowest
            right = f"CASE WHEN {width} - {z} > {q} THEN reverse({right}) ELSE {_NONE} END"
            left = f"CASE WHEN {width} - {o} > {q} THEN {left} ELSE {_NONE} END"
            return (f"CASE WHEN {z} = {width} - {q} AND {o} = {width} - {q} THEN array(substr({a}, 1, {q} - 1)) ELSE "
                    f"concat(array(substr({a}, 1, {width} - {z})), {right}, {left}, array(substr({b}, 1, {width} - {o}))) END")

        ends = (f"named_struct('z', CAST(least({width} - {q}, {width} - length(TRIM(TRAILING '0' FROM {a}))) AS INT), "
                f"'o', CAST(least({width} - {q}, {width} - length(TRIM(TRAILING '1' FROM {b}))) AS INT))")
        return f"CASE WHEN {q} = 0 THEN array({a}) ELSE {ipaddr.let_sql(ends, halves)} END"

    def place(e):
        differ = f"transform(sequence(1, {width}), {j} -> substr({e}.a, {j}, 1) <> substr({e}.b, {j}, 1))"
        return ipaddr.let_sql(f"named_struct('a', {e}.a, 'b', {e}.b, 'q', CAST(array_position({differ}, true) AS INT))", cut)

    return ipaddr.let_sql(f"named_struct('a', {lo}, 'b', {hi})", place)


def prefix_table(intervals: DataFrame) -> DataFrame:
    """Disjoint intervals ``family, lo, hi`` (hex) -> ``family, bits``: their least sets of prefixes."""
    both = None
    for family, width in BITS.items():
        digits = width // 4
        own = intervals.filter(F.col("family") == family).selectExpr(
            "family", f"{ipaddr.hex_to_bits_sql('lo', digits)} AS a", f"{ipaddr.hex_to_bits_sql('hi', digits)} AS b"
        )
        own = own.selectExpr("family", f"explode({least_prefixes_sql('a', 'b', width)}) AS bits")
        both = own if both is None else both.unionByName(own)
    return both


def digit_table(prefixes: DataFrame) -> DataFrame:
    """``family, bits`` -> ``family, digits, prefix``: lengthened to whole hex digits."""
    v, i = ipaddr.fresh("v"), ipaddr.fresh("i")
    n = "CAST(ceil(length(bits) / 4) AS INT)"
    free = f"({n} * 4 - length(bits))"
    longer = f"explode(transform(sequence(0, CAST(shiftleft(1, {free}) - 1 AS INT)), {v} -> concat(bits, lpad(bin({v}), {free}, '0')))) AS longer"
    hexed = f"CASE WHEN digits = 0 THEN '' ELSE array_join(transform(sequence(0, digits - 1), {i} -> lower(conv(substr(longer, 4 * {i} + 1, 4), 2, 16))), '') END"
    return prefixes.selectExpr("family", f"{n} AS digits", longer).selectExpr("family", "digits", f"{hexed} AS prefix")


def mark(
    keyed: DataFrame, family: Column, key: Column, table: DataFrame, digits: Sequence[int], out: str, *, broadcast: bool
) -> DataFrame:
    """Add boolean ``out``: does ``key`` begin with a prefix of its family. ``digits``: the lengths that ``table`` has."""
    if broadcast or keyed.isStreaming:
        result, hits = keyed, F.lit(False)
        for n in digits:
            names = [f"_f{n}", f"_p{n}"]
            own = table.filter(F.col("digits") == n).select(F.col("family").alias(names[0]), F.col("prefix").alias(names[1]))
            own = F.broadcast(own) if broadcast else own.hint("merge")
            result = result.join(own, (family == F.col(names[0])) & (key.substr(1, n) == F.col(names[1])), "left")
            hits = hits | F.col(names[1]).isNotNull()
        return result.withColumn(out, hits).drop(*[c for n in digits for c in (f"_f{n}", f"_p{n}")])
    # the distinct addresses meet the policy; a hot address is one row here, and each hit is one row of the join back
    distinct = keyed.select(family.alias("_hf"), key.alias("_hk")).filter("_hf is not null").distinct()
    tried = distinct.select("_hf", "_hk", F.explode(F.array(*[F.lit(n) for n in digits])).alias("_hn"))
    own = table.select(F.col("family").alias("_hf"), F.col("digits").alias("_hn"), F.col("prefix").alias("_hp"))
    found = tried.withColumn("_hp", F.expr("substr(_hk, 1, _hn)")).join(own.hint("merge"), ["_hf", "_hn", "_hp"]).select("_hf", "_hk")
    result = keyed.join(found, (family == F.col("_hf")) & (key == F.col("_hk")), "left")
    return result.withColumn(out, F.col("_hk").isNotNull()).drop("_hf", "_hk")
