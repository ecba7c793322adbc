"""Anonymization dataflow: sensitive addresses -> mapping table -> rewritten cells.

Plan, for ``flows`` and anonymized columns ``cols``:

1. ``sensitive_ips``: explode the address cells, count them per address, and
   keep the addresses the policy marks sensitive. The count is a partial
   (map-side) aggregation, so a hot address costs one row per task, not one per
   flow, and the policy is asked once for each address.
2. ``build_mapping``: one Crypto-PAn pseudonym per distinct address. This is
   the only expensive expression (32 or 128 AES blocks) and it runs once per
   address, not per cell. The table is reversible (``deanonymize``).
3. ``apply_mapping``: rewrite each column with a left join on the trimmed
   cell. The mapping holds at most one row per address covered by the
   policy; its row count is checked, and it is broadcast only under the
   limit. Above it a shuffle join is used, with the same result, and adaptive
   execution splits skewed partitions. Pseudonyms are computed inline, without
   a mapping, only where that is asked for.

A sensitive cell is never left in clear: a policy-sensitive cell without a
mapping becomes NULL, or raises with ``strict=True``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift import schemas
from netsift.functions import cryptopan as cp
from netsift.functions import ipaddr
from netsift.operators import policy as pol

# a row is two addresses of at most 45 characters: some 30 MB of broadcast
MAX_BROADCAST_MAPPING_ROWS = 200_000


def address_cells(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per address cell: ``column, ip`` (trimmed text) (A6, first step)."""
    cells = F.explode(F.arrays_zip(F.array(*[F.lit(c) for c in cols]).alias("column"),
                                   F.array(*[ipaddr.java_trim(c) for c in cols]).alias("ip")))
    return df.select(cells.alias("_c")).select(F.col("_c.column").alias("column"), F.col("_c.ip").alias("ip"))


def sensitive_ips(
    df: DataFrame,
    cols: Sequence[str] = schemas.DEFAULT_ANONYMIZE_COLUMNS,
    policy: pol.Policy | None = None,
    *,
    plan: str = "auto",
) -> DataFrame:
    """Distinct sensitive addresses with their cell counts: ``original_ip, family, n_cells``."""
    counted = address_cells(df, cols).groupBy("ip").agg(F.count(F.lit(1)).alias("n_cells"))
    marked = pol.match_policy(counted, "ip", policy, plan=plan, out="_sensitive")
    # the condition names the count, so it stays above the aggregation: the policy is asked once an address
    sensitive = marked.filter(F.when(F.col("n_cells") > 0, F.col("_sensitive")))
    return sensitive.select(F.col("ip").alias("original_ip"), ipaddr.ip_family("ip").alias("family"), "n_cells")


def build_mapping(ips: DataFrame, key: cp.Key, column: str = "original_ip", partitions: int | None = None) -> DataFrame:
    """Distinct addresses -> ``original_ip, obfuscated_ip, family, n_cells`` (A3, A4).

    Crypto-PAn costs 32 or 128 AES blocks per row, while the distinct rows are
    few bytes: left to adaptive execution, the shuffle after the distinct step
    would be coalesced by size into a handful of partitions and the cipher work
    would run on a handful of cores. The rows are therefore hash-partitioned
    by address into an explicit number of partitions (the cluster's default
    parallelism), which adaptive execution keeps. Only distinct rows move.
    Where very many addresses share networks, ``prefix_cipher`` needs fewer calls.
    """
    extra = [c for c in ("family", "n_cells") if c in ips.columns]
    n = partitions or ips.sparkSession.sparkContext.defaultParallelism
    ips = cp.with_key(ips.repartition(n, column), key)
    return ips.select(
        F.col(column).alias("original_ip"),
        cp.cryptopan(column, key).alias("obfuscated_ip"),
        *extra,
    )


def policy_mapping(policy: pol.Policy, key: cp.Key, limit: int = MAX_BROADCAST_MAPPING_ROWS) -> DataFrame | None:
    """``key, obfuscated_ip`` of every address that the policy covers, by hex digits; None if there are more than ``limit``.

    With it ``apply_policy_mapping`` needs no cipher, no state and no pass over the rows before it, so a stream can use it.
    """
    covered = pol.covered_addresses(policy, limit)
    if covered is None:
        return None
    rows = cp.with_key(covered.repartition(covered.sparkSession.sparkContext.defaultParallelism, "key"), key)
    v4 = ipaddr.let_sql(cp.cryptopan_v4_sql(ipaddr.hex_to_long_sql("key"), key), ipaddr.long_to_v4_sql)
    v6 = ipaddr.let_sql(cp.cryptopan_v6_sql("key", key), ipaddr.hex_to_v6_sql)
    return materialize(rows.selectExpr("key", f"CASE WHEN family = {ipaddr.V4} THEN {v4} ELSE {v6} END AS obfuscated_ip"))


def apply_policy_mapping(df: DataFrame, cols: Sequence[str], mapping: DataFrame) -> DataFrame:
    """``apply_mapping`` with the mapping of all addresses of a policy: a cell whose address is in it gets the pseudonym."""
    out = df
    for c in cols:
        mc = F.broadcast(mapping.select(F.col("key").alias(f"_{c}_key"), F.col("obfuscated_ip").alias(f"_{c}_obf")))
        # the keys of the families differ in length
        out = out.join(mc, ipaddr.ip_key(c) == F.col(f"_{c}_key"), "left")
        out = out.withColumn(c, F.coalesce(f"_{c}_obf", c)).drop(f"_{c}_key", f"_{c}_obf")
    return out


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut lineage with a reliable checkpoint in the cluster's checkpoint folder.

    A mapping is reused by every output and by de-anonymization; reading it
    back from the checkpoint also keeps the key out of later plans. The input
    is persisted first so the checkpoint does not compute it a second time.
    """
    from netsift.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def _unmapped(strict: bool, column: str) -> Column:
    if strict:
        return F.raise_error(F.lit(f"sensitive address in {column} has no mapping"))
    return F.lit(None).cast("string")


def apply_mapping(
    df: DataFrame,
    cols: Sequence[str] = schemas.DEFAULT_ANONYMIZE_COLUMNS,
    mapping: DataFrame | None = None,
    *,
    policy: pol.Policy | None = None,
    key: cp.Key | None = None,
    strategy: str = "auto",
    strict: bool = False,
    unique: bool = False,
    flag: bool = False,
    only_flagged: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_MAPPING_ROWS,
) -> DataFrame:
    """Replace sensitive addresses in ``cols`` by their pseudonyms (A1, A2, M9).

    A cell found in the mapping gets the pseudonym; other cells keep their
    text unchanged (whitespace included). With ``policy`` given, a cell the
    policy marks sensitive but the mapping lacks becomes NULL (or raises with
    ``strict``): it never passes in clear.

    ``strategy``: ``broadcast`` (mapping under ``max_broadcast_rows``, checked),
    ``inline`` (needs ``key`` and ``policy``; no join), ``shuffle``, or ``auto``:
    ``inline`` without a mapping, else one of the joins by the mapping's size;
    the result does not depend on which. ``unique`` says that the mapping has
    one row per address, as ``build_mapping`` gives it. ``flag`` adds
    ``<column>_anonymized``, and ``only_flagged`` replaces only cells that are
    so flagged (see ``deanonymize``).
    """
    n = None
    if mapping is not None and strategy in ("auto", "broadcast"):
        n = mapping.count()
    if strategy == "auto":
        strategy = "inline" if mapping is None else "broadcast" if n <= max_broadcast_rows else "shuffle"
    if strategy == "inline":
        if key is None or policy is None:
            raise ValueError("inline anonymization needs the key and the policy")
        out = cp.with_key(df, key)
        for c in cols:
            out = pol.match_policy(out, c, policy, out=f"_{c}_s")
            pseudonym = F.expr(cp.cryptopan_sql(ipaddr.trim_sql(ipaddr.name(c)), key))
            out = out.withColumn(c, F.when(F.col(f"_{c}_s"), pseudonym).otherwise(F.col(c)))
            if flag:
                out = out.withColumn(f"{c}_anonymized", F.col(f"_{c}_s"))
            out = out.drop(f"_{c}_s")
        return out.drop(cp.KEY_COLUMN)
    if mapping is None:
        raise ValueError(f"strategy {strategy!r} needs a mapping table")
    if strategy == "broadcast" and n > max_broadcast_rows:
        raise ValueError(f"mapping has {n} rows, above max_broadcast_rows={max_broadcast_rows}")
    if strategy not in ("broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    m = mapping.select("original_ip", "obfuscated_ip")
    m = m if unique else m.dropDuplicates(["original_ip"])
    out = df
    for c in cols:
        mc = m.select(F.col("original_ip").alias(f"_{c}_orig"), F.col("obfuscated_ip").alias(f"_{c}_obf"))
        if strategy == "broadcast":
            mc = F.broadcast(mc)
        same = ipaddr.java_trim(c) == F.col(f"_{c}_orig")
        out = out.join(mc, same & F.col(f"{c}_anonymized") if only_flagged else same, "left")
        mapped = F.col(f"_{c}_orig").isNotNull()
        if flag:
            out = out.withColumn(f"{c}_anonymized", mapped)
        if policy is not None:
            out = pol.match_policy(out, c, policy, out=f"_{c}_s")
            value = F.when(mapped, F.col(f"_{c}_obf")).when(F.col(f"_{c}_s"), _unmapped(strict, c)).otherwise(F.col(c))
            out = out.withColumn(c, value).drop(f"_{c}_s")
        else:
            out = out.withColumn(c, F.when(mapped, F.col(f"_{c}_obf")).otherwise(F.col(c)))
        out = out.drop(f"_{c}_orig", f"_{c}_obf")
    return out


def reverse_mapping(mapping: DataFrame) -> DataFrame:
    """``obfuscated_ip -> original_ip``, one original per pseudonym.

    The original text is given back as it was seen. Several texts of one
    address (``::1`` and ``0:0:0:0:0:0:0:1``) share a pseudonym; the least
    text is then returned, so the answer is deterministic.
    """
    return mapping.groupBy("obfuscated_ip").agg(F.min("original_ip").alias("original_ip"))


def deanonymize(
    df: DataFrame,
    cols: Sequence[str] = schemas.DEFAULT_ANONYMIZE_COLUMNS,
    mapping: DataFrame | None = None,
    *,
    max_broadcast_rows: int = MAX_BROADCAST_MAPPING_ROWS,
) -> DataFrame:
    """Put original addresses back (A5): pseudonym cells -> canonical original text.

    A pseudonym may be a real address that also stands in clear somewhere.
    Where ``df`` has the flags of ``apply_mapping(..., flag=True)``, only flagged
    cells are put back; without flags, clear cells that equal a pseudonym
    cannot be told apart and are put back too.
    """
    rev = reverse_mapping(mapping).select(
        F.col("obfuscated_ip").alias("original_ip"), F.col("original_ip").alias("obfuscated_ip")
    )
    flagged = all(f"{c}_anonymized" in df.columns for c in cols)
    return apply_mapping(df, cols, rev, strategy="auto", unique=True, only_flagged=flagged, max_broadcast_rows=max_broadcast_rows)


def inverse_mapping(pseudonyms: DataFrame, key: cp.Key, column: str = "obfuscated_ip", partitions: int | None = None) -> DataFrame:
    """Distinct pseudonyms -> ``obfuscated_ip, original_ip``, by the key alone; NULL where a text is not an address.

    As in ``build_mapping`` the few distinct rows are dealt over all cores, since the cipher is the cost.
    """
    n = partitions or pseudonyms.sparkSession.sparkContext.defaultParallelism
    rows = cp.with_key(pseudonyms.repartition(n, column), key)
    return rows.select(F.col(column).alias("obfuscated_ip"), cp.cryptopan_inverse(column, key).alias("original_ip"))


def deanonymize_by_key(
    df: DataFrame,
    cols: Sequence[str] = schemas.DEFAULT_ANONYMIZE_COLUMNS,
    *,
    key: cp.Key,
    policy: pol.Policy | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_MAPPING_ROWS,
) -> DataFrame:
    """Put original addresses back without a mapping table (A5): distinct pseudonyms are decrypted, then joined to the cells.

    Flagged cells (``apply_mapping(..., flag=True)``) are put back. Records without flags need the
    ``policy``: a cell is then put back if the address behind it is sensitive, as each
    pseudonym's is; a clear cell equal to a pseudonym cannot be told apart. Addresses come
    back in canonical text, as the key knows addresses and not how they were written.
    """
    flagged = all(f"{c}_anonymized" in df.columns for c in cols)
    if not flagged and policy is None:
        raise ValueError("records without flags need the policy, to tell pseudonyms from clear addresses")
    texts = [F.when(F.col(f"{c}_anonymized"), ipaddr.java_trim(c)) if flagged else ipaddr.java_trim(c) for c in cols]
    cells = df.select(F.explode(F.array(*texts)).alias("obfuscated_ip")).filter("obfuscated_ip is not null")
    # Written before they are decrypted: a filter on the address would be pushed below the distinct step, and every cell decrypted.
    pseudonyms = materialize(cells.distinct())
    found = materialize(inverse_mapping(pseudonyms, key)).filter("original_ip is not null")
    if not flagged:
        found = pol.match_policy(found, "original_ip", policy, out="_sensitive").filter("_sensitive").drop("_sensitive")
    back = found.select(F.col("obfuscated_ip").alias("original_ip"), F.col("original_ip").alias("obfuscated_ip"))
    return apply_mapping(df, cols, back, strategy="auto", unique=True, only_flagged=flagged, max_broadcast_rows=max_broadcast_rows)


def audit(mapping: DataFrame) -> DataFrame:
    """One row per looked-up address: ``original_ip, obfuscated_ip, result, n_cells`` (K8)."""
    result = F.when(F.col("obfuscated_ip").isNotNull(), F.lit("anonymized")).otherwise(F.lit("failed"))
    return mapping.select("original_ip", "obfuscated_ip", result.alias("result"), F.col("n_cells").cast("bigint"))
