"""DuckDB SQL text builders for the oracle side of the registered queries.

The oracle must not share code paths with the Spark side: policy bounds come
from Python's ``ipaddress`` module, addresses are converted by DuckDB.
"""

from __future__ import annotations

import ipaddress

V4_RE = r"^((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$"


def v4_num(x: str) -> str:
    t = f"trim({x})"
    parts = " + ".join(
        f"CAST(split_part({t}, '.', {i + 1}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4)
    )
    return f"(CASE WHEN regexp_matches({t}, '{V4_RE}') THEN {parts} END)"


def v6_hex(x: str) -> str:
    """Plain IPv6 text (no zone, no dotted quad) -> 32 hex digits, in DuckDB SQL."""
    s = f"lower(trim({x}))"
    left = f"split_part({s}, '::', 1)"
    right = f"split_part({s}, '::', 2)"
    nl = f"(CASE WHEN {left} = '' THEN 0 ELSE len(string_split({left}, ':')) END)"
    nr = f"(CASE WHEN {right} = '' THEN 0 ELSE len(string_split({right}, ':')) END)"
    zeros = f"substr('0:0:0:0:0:0:0:0', 1, 2 * (8 - {nl} - {nr}) - 1)"
    expanded = (f"(CASE WHEN contains({s}, '::') THEN concat_ws(':', nullif({left}, ''), {zeros}, nullif({right}, '')) "
                f"ELSE {s} END)")
    return (f"(CASE WHEN contains({s}, ':') THEN array_to_string(list_transform(string_split({expanded}, ':'), "
            f"lambda g: lpad(g, 4, '0')), '') END)")


def _interval(rule: str, include_edges: bool = False):
    """Python-ipaddress model of one policy rule -> (family, lo, hi) or None."""
    rule = rule.strip()
    if not rule:
        return None
    if "," in rule:
        a, b = (ipaddress.ip_address(p.strip()) for p in rule.split(",")[:2])
        lo, hi = min(a, b), max(a, b)
    elif "/" in rule:
        net = ipaddress.ip_network(rule, strict=False)
        lo, hi = net.network_address, net.broadcast_address
        if net.version == 4 and not include_edges:
            if net.prefixlen >= 31:
                return None
            lo, hi = lo + 1, hi - 1
    else:
        lo = hi = ipaddress.ip_address(rule)
    return lo.version, int(lo), int(hi)


def membership(x: str, rules, include_edges: bool = False) -> str:
    """DuckDB boolean: is the address text ``x`` inside any rule."""
    terms = []
    for r in rules:
        iv = _interval(r, include_edges)
        if iv is None:
            continue
        fam, lo, hi = iv
        if fam == 4:
            terms.append(f"({v4_num(x)} BETWEEN {lo} AND {hi})")
        else:
            terms.append(f"({v6_hex(x)} BETWEEN '{lo:032x}' AND '{hi:032x}')")
    return "coalesce(" + " OR ".join(terms or ["false"]) + ", false)"


def canonical(x: str) -> str:
    """Canonical address text for the fixture forms (v4 as is, v6 already short)."""
    return f"trim({x})"
