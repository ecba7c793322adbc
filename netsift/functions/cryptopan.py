"""Prefix-preserving pseudonyms (Crypto-PAn, Xu, Fan, Ammar and Moon, 2002).

The 32-byte key splits into an AES-128 key (bytes 0-15) and pad material
(bytes 16-31, encrypted once with the AES key). For bit position i of an
address, a 128-bit block is formed from the first i address bits followed by
the remaining pad bits; the top bit of AES(block) is the one-time-pad bit i.
The pseudonym is address XOR pad bits, so two addresses sharing a k-bit prefix
map to pseudonyms sharing a k-bit prefix, and the map is a bijection. It is
inverted from the first bit to the last: bit i of the pad depends on the i address bits
before it, which are known when bit i of the pseudonym is looked at.

Built from Spark's ``aes_encrypt`` inside ``transform``/``aggregate`` lambdas:
one AES block per bit (32 for IPv4, 128 for IPv6), the 32 blocks of a word in one
call, all inside the JVM; the inverse calls AES bit by bit. The pad
is a constant expression that Catalyst folds. Run it on distinct addresses
where these can be had.

A key is 32 bytes, which then are literals of the plan, or a ``KeyFile``: the executors read
the file, and plans and event logs name its path only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.functions import ipaddr as ip

_WORD = 0xFFFFFFFF


KEY_COLUMN = "_cryptopan_key"


@dataclass(frozen=True)
class KeyFile:
    """A key in a file of 32 bytes that all executors can read. The cipher's expressions take it from a
    column that ``with_key`` adds; a file of another length raises when it is read."""

    path: str


Key = bytes | KeyFile


def with_key(df: DataFrame, key: Key) -> DataFrame:
    """``df`` with the column the cipher's expressions need under this key: none for bytes, the content of a ``KeyFile`` else.

    The file is read once by a scalar subquery, so that its content is a value at run time and no part of a plan.
    """
    if not isinstance(key, KeyFile):
        return df
    aes, pad = "substring(content, 1, 16)", "substring(content, 17, 16)"
    encrypted = f"hex(substring(aes_encrypt({pad}, {aes}, 'ECB', 'PKCS'), 1, 16))"
    words = ", ".join(ip.hex_to_long_sql(f"substr({encrypted}, {1 + 8 * j}, 8)") for j in range(4))
    wrong = "raise_error('Crypto-PAn key must be 32 bytes')"
    value = f"CASE WHEN octet_length(content) = 32 THEN struct({aes} AS aes, array({words}) AS pad) ELSE {wrong} END AS v"
    secret = df.sparkSession.read.format("binaryFile").load(key.path).selectExpr(value)
    return df.withColumn(KEY_COLUMN, secret.scalar())


def write_key_file(spark: SparkSession, path: str, key: bytes) -> KeyFile:
    """Write a key file that its owner alone can read; the key passes through no query."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(at, False)
    fs.setPermission(at, spark._jvm.org.apache.hadoop.fs.permission.FsPermission("600"))
    out.write(bytearray(_check_key(key)))
    out.close()
    return KeyFile(path)


def _check_key(key: Key) -> Key:
    if isinstance(key, KeyFile):
        return key
    if not isinstance(key, (bytes, bytearray)) or len(key) != 32:
        raise ValueError("Crypto-PAn key must be 32 bytes")
    return bytes(key)


def _aes_key(key: Key) -> str:
    return f"{KEY_COLUMN}.aes" if isinstance(key, KeyFile) else f"X'{key[:16].hex()}'"


@lru_cache(maxsize=32)
def _pad_words_of(key: bytes) -> tuple[int, int, int, int]:
    """The key's encrypted pad as four 32-bit words.

    A constant of the key, not of the data: one AES call in a one-row query,
    done once per key, so the cipher expressions carry plain literals.
    """
    spark = SparkSession.getActiveSession()
    pad = spark.range(1).selectExpr(
        f"hex(substring(aes_encrypt(X'{key[16:].hex()}', {_aes_key(key)}, 'ECB', 'PKCS'), 1, 16)) AS p"
    ).first().p
    return tuple(int(pad[8 * j: 8 * j + 8], 16) for j in range(4))


def _pad_word(key: Key, j: int) -> str:
    return f"{KEY_COLUMN}.pad[{j}]" if isinstance(key, KeyFile) else f"CAST({_pad_words_of(key)[j]} AS BIGINT)"


def pad_hex_sql(key: Key, first: int = 0) -> str:
    """The encrypted pad from its word ``first`` on, as hex text."""
    if isinstance(key, KeyFile):
        return "concat(" + ", ".join(ip.long_to_hex_sql(_pad_word(key, j), 8) for j in range(first, 4)) + ")"
    return "'" + "".join(f"{w:08x}" for w in _pad_words_of(key)[first:]) + "'"


def top_bit_sql(block_hex: str, key: Key) -> str:
    """1 when the first bit of AES-ECB(block) is set, else 0."""
    enc = f"aes_encrypt(unhex({block_hex}), {_aes_key(key)}, 'ECB', 'PKCS')"
    return f"CAST(hex(substring({enc}, 1, 1)) >= '80' AS BIGINT)"


def _mixed(addr_w: str, pad_w: str, r: str) -> str:
    # the top r bits of a 32-bit word (r = 0..31)
    m = f"shiftleft(shiftright(CAST({_WORD} AS BIGINT), 32 - {r}), 32 - {r})"
    return f"(({addr_w} & {m}) | ({pad_w} & ({_WORD} - {m})))"


def _pads(before: str, word: str, j: int, key: Key) -> str:
    """The 32 pad bits of an address's word ``j`` as a bigint: the blocks of all of them pass through AES in one call.

    ``before``: the hex digits of the words before it.
    """
    i, acc, k = ip.fresh("i"), ip.fresh("acc"), ip.fresh("k")

    def encrypted(after: str) -> str:
        block = f"concat({before}, {ip.long_to_hex_sql(_mixed(word, _pad_word(key, j), i), 8)}, {after})"
        return f"aes_encrypt(unhex(array_join(transform(sequence(0, 31), {i} -> {block}), '')), {_aes_key(key)}, 'ECB', 'PKCS')"

    def top_bits(e: str) -> str:
        bit = f"CAST(substring({e}, 16 * {k} + 1, 1) >= X'80' AS BIGINT)"
        return f"aggregate(sequence(0, 31), CAST(0 AS BIGINT), ({acc}, {k}) -> {acc} * 2 + {bit})"

    return ip.let_sql(ip.let_sql(pad_hex_sql(key, j + 1), encrypted), top_bits)


def cryptopan_v4_sql(addr: str, key: Key) -> str:
    """bigint IPv4 address -> bigint pseudonym."""
    key = _check_key(key)
    return ip.let_sql(addr, lambda a: f"{a} ^ {_pads(repr(''), a, 0, key)}")


def cryptopan_v6_sql(addr_hex: str, key: Key) -> str:
    """32-hex-digit IPv6 address -> 32-hex-digit pseudonym."""
    key = _check_key(key)

    def body(h):
        def word(j):
            own = ip.hex_to_long_sql(f"substr({h}, {1 + 8 * j}, 8)")
            return ip.let_sql(own, lambda a: ip.long_to_hex_sql(f"{a} ^ {_pads(f'substr({h}, 1, {8 * j})', a, j, key)}", 8))

        return "concat(" + ", ".join(word(j) for j in range(4)) + ")"

    return ip.let_sql(addr_hex, body)


def _recover(word: str, block_hex, key: Key) -> str:
    """The 32 address bits behind a pseudonym's word, bit by bit: pad bit i needs only the i bits before it, which are known by then.

    ``block_hex`` makes the cipher's block from the word's known bits (at the top of a 32-bit word) and their number.
    """
    acc, i = ip.fresh("acc"), ip.fresh("i")
    known = f"shiftleft({acc}, 32 - {i})"
    bit = f"(shiftright({word}, 31 - {i}) & CAST(1 AS BIGINT))"
    return f"aggregate(sequence(0, 31), CAST(0 AS BIGINT), ({acc}, {i}) -> {acc} * 2 + ({bit} ^ {top_bit_sql(block_hex(known, i), key)}))"


def cryptopan_inverse_v4_sql(pseudonym: str, key: Key) -> str:
    """bigint pseudonym -> bigint IPv4 address."""
    key = _check_key(key)
    pad_rest = pad_hex_sql(key, 1)

    def block(known, i):
        return f"concat({ip.long_to_hex_sql(_mixed(known, _pad_word(key, 0), i), 8)}, {pad_rest})"

    return ip.let_sql(pseudonym, lambda c: _recover(c, block, key))


def cryptopan_inverse_v6_sql(pseudonym_hex: str, key: Key) -> str:
    """32-hex-digit pseudonym -> 32-hex-digit IPv6 address, word after word."""
    key = _check_key(key)

    def word(c: str, before: list[str]) -> str:
        j = len(before)
        if j == 4:
            return "concat(" + ", ".join(ip.long_to_hex_sql(a, 8) for a in before) + ")"

        def block(known, i):
            parts = [*before, _mixed(known, _pad_word(key, j), i), *[_pad_word(key, k) for k in range(j + 1, 4)]]
            return "concat(" + ", ".join(ip.long_to_hex_sql(x, 8) for x in parts) + ")"

        return ip.let_sql(_recover(f"{c}[{j}]", block, key), lambda a: word(c, [*before, a]))

    def words(h):
        return "array(" + ", ".join(ip.hex_to_long_sql(f"substr({h}, {1 + 8 * j}, 8)") for j in range(4)) + ")"

    return ip.let_sql(ip.let_sql(pseudonym_hex, words), lambda c: word(c, []))


def cryptopan_inverse_sql(x: str, key: Key) -> str:
    """Pseudonym text of either family -> address text, in the short form for IPv6 (NULL if not an address)."""

    def body(t):
        # each recovered address is named once: what follows repeats its input
        v6 = ip.let_sql(cryptopan_inverse_v6_sql(ip.v6_to_hex_sql(t), key), ip.hex_to_v6_sql)
        v4 = ip.let_sql(cryptopan_inverse_v4_sql(ip.v4_to_long_sql(t), key), ip.long_to_v4_sql)
        return f"CASE WHEN {ip.is_v6_sql(t)} THEN {v6} WHEN {ip.v4_to_long_sql(t)} IS NOT NULL THEN {v4} END"

    return ip.let_sql(x, body)


def cryptopan_inverse(c: str, key: Key) -> Column:
    """The address behind the pseudonym in column ``c`` (with a ``KeyFile``: of a table ``with_key``)."""
    return F.expr(cryptopan_inverse_sql(ip.name(c), key))


def cryptopan_sql(x: str, key: Key) -> str:
    """Address text of either family -> pseudonym text of the same family (NULL if not an address)."""

    def body(t):
        # each pseudonym is named once: what follows repeats its input
        v6 = ip.let_sql(cryptopan_v6_sql(ip.v6_to_hex_sql(t), key), ip.hex_to_v6_sql)
        v4 = ip.let_sql(cryptopan_v4_sql(ip.v4_to_long_sql(t), key), ip.long_to_v4_sql)
        return f"CASE WHEN {ip.is_v6_sql(t)} THEN {v6} WHEN {ip.v4_to_long_sql(t)} IS NOT NULL THEN {v4} END"

    return ip.let_sql(x, body)


def cryptopan(c: str, key: Key) -> Column:
    """Pseudonym of the address in column ``c`` (with a ``KeyFile``: of a table ``with_key``)."""
    return F.expr(cryptopan_sql(ip.name(c), key))
