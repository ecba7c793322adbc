"""IP address expressions, all JVM-side.

Each helper has two forms: ``*_sql(x)`` returns Spark SQL text over a SQL
expression ``x`` (a column name or any expression), and the plain name
returns a ``Column`` for a column name. Building the text is pure Python and
Spark parses it in one call, which keeps plan construction cheap.

Addresses are compared as fixed-width lowercase hex text: 8 digits for IPv4,
32 for IPv6. Within one family lexicographic order equals numeric order, so
ranges and prefix buckets work on plain strings.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

from netsift.schemas import IPV6_PATTERN

V4, V6 = 4, 6

_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
V4_TEXT = rf"^({_OCTET}\.){{3}}{_OCTET}$"
V6_TEXT = f"^(?:{IPV6_PATTERN})$"
_QUAD_TAIL = r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})$"
_names = count()


def lit(s: str) -> str:
    """A Spark SQL string literal holding ``s`` exactly."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fresh(prefix: str) -> str:
    """A lambda variable name not used elsewhere in the same expression."""
    return f"{prefix}_{next(_names)}"


def let_sql(value: str, body) -> str:
    """Evaluate ``value`` once and hand its name to ``body`` (a str -> str function)."""
    v = fresh("v")
    return f"element_at(transform(array({value}), {v} -> {body(v)}), 1)"


def name(c: str) -> str:
    """SQL text for a column name."""
    return f"`{c}`" if c.isidentifier() else c


def trim_sql(x: str) -> str:
    """Strip every character <= U+0020 at both ends, as JVM String.trim does."""
    chars = "".join(f"\\u{i:04x}" for i in range(0x21))
    return f"btrim({x}, '{chars}')"


def is_v6_sql(x: str) -> str:
    t = trim_sql(x)
    return f"(instr({t}, ':') > 0 AND {t} RLIKE {lit(V6_TEXT)})"


def v4_to_long_sql(x: str) -> str:
    # No lambda here: this runs on every address cell, and plain expressions
    # stay in generated code (the repeated trim is one common subexpression).
    t = trim_sql(x)
    parts = " + ".join(f"CAST(split_part({t}, '.', {i + 1}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4))
    return f"CASE WHEN {t} RLIKE {lit(V4_TEXT)} THEN {parts} END"


def long_to_v4_sql(n: str) -> str:
    return "concat_ws('.', " + ", ".join(f"CAST(shiftright({n}, {s}) & 255 AS STRING)" for s in (24, 16, 8, 0)) + ")"


def long_to_hex_sql(n: str, width: int) -> str:
    return f"lower(lpad(hex({n}), {width}, '0'))"


def hex_to_long_sql(h: str) -> str:
    return f"CAST(conv({h}, 16, 10) AS BIGINT)"


def v4_to_hex_sql(x: str) -> str:
    return long_to_hex_sql(v4_to_long_sql(x), 8)


def _expand_v6_sql(s: str) -> str:
    """Lower-case IPv6 text without zone or dotted quad -> 32 hex digits or NULL."""

    def expand(p):
        left, right, whole = f"{p}[0]", f"{p}[1]", f"{p}[2]"
        nl = f"(CASE WHEN {left} = '' THEN 0 ELSE size(split({left}, ':')) END)"
        nr = f"(CASE WHEN {right} = '' THEN 0 ELSE size(split({right}, ':')) END)"
        k = f"(8 - {nl} - {nr})"
        zeros = f"substr('0:0:0:0:0:0:0:0', 1, {k} * 2 - 1)"
        compressed = f"CASE WHEN {k} >= 1 THEN concat_ws(':', nullif({left}, ''), {zeros}, nullif({right}, '')) END"
        return f"CASE WHEN instr({whole}, '::') > 0 THEN {compressed} ELSE {whole} END"

    def pad(e):
        groups = ", ".join(f"lpad(split({e}, ':')[{i}], 4, '0')" for i in range(8))
        return f"CASE WHEN {e} RLIKE {lit(r'^([0-9a-f]{1,4}:){7}[0-9a-f]{1,4}$')} THEN concat({groups}) END"

    parts = f"array(substring_index({s}, '::', 1), substring_index({s}, '::', -1), {s})"
    return let_sql(let_sql(parts, expand), pad)


def v6_to_hex_sql(x: str) -> str:
    """IPv6 text -> 32 lowercase hex digits; NULL when it is not IPv6.

    Handles `::` compression, a `%zone` suffix and a trailing dotted quad
    (v4-mapped and v4-embedded forms).
    """

    def convert(s):
        def with_quad(qt):
            def join(q):
                groups = f"concat(lower(hex(shiftright({q}, 16))), ':', lower(hex({q} & 65535)))"
                return (f"CASE WHEN {qt} = '' THEN {s} WHEN {q} IS NOT NULL "
                        f"THEN concat(substr({s}, 1, length({s}) - length({qt})), {groups}) END")

            return let_sql(v4_to_long_sql(qt), join)

        quad = f"regexp_extract({s}, {lit(_QUAD_TAIL)}, 1)"
        return _expand_v6_sql(let_sql(quad, with_quad))

    s = f"regexp_replace(lower({trim_sql(x)}), '%.*$', '')"
    return f"CASE WHEN {is_v6_sql(x)} AND size(split({s}, '::')) <= 2 THEN {let_sql(s, convert)} END"


def hex_to_v6_sql(h: str) -> str:
    """32 hex digits -> IPv6 text in RFC 5952 short form (`2001:db8::1`).

    The longest run of two or more zero groups becomes `::`; at equal length
    the first run.
    """
    grouped = f"regexp_replace(lower({h}), {lit('(.{4})(?!$)')}, '$1:')"
    full = f"regexp_replace({grouped}, {lit('(^|:)0{1,3}(?=[0-9a-f])')}, '$1')"

    def shorten(t):
        branches = []
        for k in range(8, 1, -1):  # widest run first
            test = lit(rf"(^|:)0(:0){{{k - 1}}}(:|$)")
            run = lit(rf"^(.*?)(?:^|:)0(?::0){{{k - 1}}}(?::|$)(.*)$")
            branches.append(f"WHEN {t} RLIKE {test} THEN regexp_replace({t}, {run}, '$1::$2')")
        return f"CASE {' '.join(branches)} ELSE {t} END"

    return f"CASE WHEN {h} IS NOT NULL THEN {let_sql(full, shorten)} END"


def ip_family_sql(x: str) -> str:
    return f"CASE WHEN {is_v6_sql(x)} THEN {V6} WHEN {v4_to_long_sql(x)} IS NOT NULL THEN {V4} END"


def ip_key_sql(x: str) -> str:
    return f"CASE WHEN {is_v6_sql(x)} THEN {v6_to_hex_sql(x)} ELSE {v4_to_hex_sql(x)} END"


def ip_text_sql(family: str, key: str) -> str:
    return f"CASE WHEN {family} = {V6} THEN {hex_to_v6_sql(key)} ELSE {long_to_v4_sql(hex_to_long_sql(key))} END"


def hex_to_bits_sql(h: str, width: int) -> str:
    return "concat(" + ", ".join(f"lpad(conv(substr({h}, {i}, 1), 16, 2), 4, '0')" for i in range(1, width + 1)) + ")"


def bits_to_hex_sql(b: str, width: int) -> str:
    return "lower(concat(" + ", ".join(f"conv(substr({b}, {4 * i + 1}, 4), 2, 16)" for i in range(width)) + "))"


# Column forms, for a column name


def java_trim(c: str) -> Column:
    return F.expr(trim_sql(name(c)))


def is_v6(c: str) -> Column:
    return F.expr(is_v6_sql(name(c)))


def v4_to_long(c: str) -> Column:
    return F.expr(v4_to_long_sql(name(c)))


def v4_to_hex(c: str) -> Column:
    return F.expr(v4_to_hex_sql(name(c)))


def v6_to_hex(c: str) -> Column:
    return F.expr(v6_to_hex_sql(name(c)))


def hex_to_v6(c: str) -> Column:
    return F.expr(hex_to_v6_sql(name(c)))


def long_to_v4(c: str) -> Column:
    return F.expr(long_to_v4_sql(name(c)))


def ip_family(c: str) -> Column:
    return F.expr(ip_family_sql(name(c)))


def ip_key(c: str) -> Column:
    return F.expr(ip_key_sql(name(c)))


def ip_text(family: str, key: str) -> Column:
    return F.expr(ip_text_sql(name(family), name(key)))
