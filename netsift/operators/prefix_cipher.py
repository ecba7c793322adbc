"""Crypto-PAn over shared prefixes: one AES call for each distinct prefix of the addresses (A4).

Bit i of the pad depends on the i address bits before it, so addresses of one
network share the calls of their common prefix. Addresses are cut into pieces
of 16 bits; a *word* is a prefix that ends with a piece (two levels of them for
IPv4, eight for IPv6; the cipher's block does not tell the families apart, so
they share words).

1. All words of all addresses, distinct (a map-side combine first: the words of
   a hot network cost one row per task).
2. Words of one parent are sorted. A word has the prefixes that its forerunner
   has, up to the first bit in which they differ; it calls AES for the others
   and takes the remaining pad bits from the rows before it. That is one window,
   whose groups hold 65,536 words at most, whatever the data.
3. Level by level a word's pseudonym is that of its parent and its own 16 bits.
   No parent has more than 65,536 children, so no join key is hot.

The result is that of ``anonymize.build_mapping``. Its 128 calls for each IPv6 address
become as many as there are distinct prefixes, for the price of a
few shuffles: worth it where many addresses share networks.

Texts that are no address, and nulls, have a null pseudonym. Several texts of an
address are several rows with one pseudonym; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsift.functions import cryptopan as cp
from netsift.functions import ipaddr as ip
from netsift.operators.anonymize import materialize

PIECE = 16
LEVELS = 128 // PIECE
V4_LEVELS = 32 // PIECE
_DIGITS = PIECE // 4


def keyed(ips: DataFrame, column: str) -> DataFrame:
    """The rows with ``_hex``, the address as 8 or 32 hex digits (NULL if not an address)."""
    return ips.withColumn("_hex", F.expr(ip.ip_key_sql(ip.name(column))))


def words(hexes: DataFrame, column: str = "_hex") -> DataFrame:
    """``prefix, parent`` (hex digits): the distinct words of all addresses."""
    cut = f"transform(sequence(1, length({column}) div {_DIGITS}), l -> substr({column}, 1, {_DIGITS} * l))"
    rows = hexes.filter(F.col(column).isNotNull()).select(F.explode(F.expr(cut)).alias("prefix")).distinct()
    return rows.withColumn("parent", F.expr(f"substr(prefix, 1, length(prefix) - {_DIGITS})"))


def encrypted_words(found: DataFrame, key: cp.Key) -> DataFrame:
    """``prefix, parent, own, n_calls``: a word's own 16 encrypted bits as hex digits, and the AES calls it took."""
    order = Window.partitionBy("parent").orderBy("prefix")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bits = f"cast(conv(substr(prefix, -{_DIGITS}), 16, 10) as bigint)"
    rows = found.withColumn("bits", F.expr(bits))
    rows = rows.withColumn("forerunner", F.lag("bits").over(order))
    # the prefixes of 0 to `shared` bits below the parent are the forerunner's too
    rows = rows.withColumn("shared", F.expr(f"if(forerunner is null, -1, {PIECE} - length(bin(bits ^ forerunner)))"))
    rows = cp.with_key(rows, key)
    rows = rows.withColumn("pad", F.expr(cp.pad_hex_sql(key)))
    rows = rows.withColumn("here", F.expr(f"cast(conv(substr(pad, length(parent) + 1, {_DIGITS}), 16, 10) as bigint)"))
    rows = rows.withColumn("rest", F.expr("substr(pad, length(prefix) + 1)"))
    calls = []
    for j in range(PIECE):
        low = (1 << (PIECE - j)) - 1
        mixed = f"((bits & {((1 << PIECE) - 1) - low}) | (here & {low}))"
        block = f"concat(parent, {ip.long_to_hex_sql(mixed, _DIGITS)}, rest)"
        calls.append(F.expr(f"if({j} > shared, {cp.top_bit_sql(block, key)}, null)").alias(f"call_{j}"))
    rows = rows.select("prefix", "parent", "bits", "shared", *calls)
    pads = [F.last(f"call_{j}", ignorenulls=True).over(before).alias(f"pad_{j}") for j in range(PIECE)]
    rows = rows.select("prefix", "parent", "bits", "shared", *pads)
    pad = " + ".join(f"pad_{j} * {1 << (PIECE - 1 - j)}" for j in range(PIECE))
    return rows.select("prefix", "parent", F.expr(ip.long_to_hex_sql(f"(bits ^ ({pad}))", _DIGITS)).alias("own"),
                       (F.lit(PIECE - 1) - F.col("shared")).alias("n_calls"))


def _pseudonyms(done: DataFrame) -> DataFrame:
    """``prefix, pseudonym`` (hex digits) of the whole addresses, from the first level to the last."""
    level = [done.filter(F.length("prefix") == _DIGITS * (i + 1)) for i in range(LEVELS)]
    known, out = level[0].select("prefix", F.col("own").alias("pseudonym")), None
    for i in range(1, LEVELS):
        up = known.select(F.col("prefix").alias("parent"), F.col("pseudonym").alias("above"))
        known = level[i].join(up, "parent").select("prefix", F.concat("above", "own").alias("pseudonym"))
        if i == V4_LEVELS - 1:
            known = out = materialize(known)  # the pairs of IPv4 and the parents of IPv6
    return out.unionByName(known)


def build_mapping_by_prefixes(ips: DataFrame, key: cp.Key, column: str = "original_ip") -> DataFrame:
    """Distinct addresses -> ``original_ip, obfuscated_ip, family, n_cells``, as ``build_mapping`` gives them (the
    last two where ``ips`` has them)."""
    extra = [c for c in ("family", "n_cells") if c in ips.columns]
    rows = materialize(keyed(ips.select(column, *extra), column))
    pairs = _pseudonyms(materialize(encrypted_words(words(rows), key)))
    text = f"if(length(pseudonym) = 8, {ip.long_to_v4_sql(ip.hex_to_long_sql('pseudonym'))}, {ip.hex_to_v6_sql('pseudonym')})"
    joined = rows.join(pairs, F.col("_hex") == F.col("prefix"), "left")
    return joined.select(F.col(column).alias("original_ip"), F.expr(text).alias("obfuscated_ip"), *extra)
