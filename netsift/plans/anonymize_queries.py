"""Registered policy-membership and anonymization queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsift import fixtures, schemas
from netsift.functions.cryptopan import write_key_file
from netsift.operators import anonymize as anon
from netsift.operators import features as feat
from netsift.operators import flow as flowop
from netsift.operators import policy as pol
from netsift.operators import prefix_cipher
from netsift.operators.mapping_store import MappingStore
from netsift.plans import duck
from netsift.plans.common import FEATURES_SQL, FLOW_CTE, POLICY, SAMPLE_KEY, parsed_flows, with_cte
from netsift.plans.registry import register
from netsift.session import scratch_path

FLOW = with_cte(FLOW_CTE)
COLS = list(schemas.DEFAULT_ANONYMIZE_COLUMNS)

# Policies of the membership queries: one rule form each, then all forms with overlaps.
MATCH_CASES = {
    "policy_match_v4_exact": ("10.10.5.7", "192.168.10.20"),
    "policy_match_v4_range": ("10.10.11.20,10.10.11.90", "192.168.10.200,192.168.10.100"),
    "policy_match_v4_subnet": ("10.10.5.0/24", "192.168.10.0/25", "10.10.77.128/26", "10.10.11.4/31", "10.10.11.9/32"),
    "policy_match_v6_exact": ("2001:DB8::5", "fddd:be2e:c6ba::3"),
    "policy_match_v6_range": ("2001:db8::1,2001:db8::7",),
    "policy_match_v6_subnet": ("fddd:be2e:c6ba::/116", "2001:db8::/125"),
}
ANY_POLICY = POLICY + ("192.168.10.0,192.168.10.50", "10.10.5.100", "2001:db8::2,2001:db8::4", "10.10.77.0/28")


def _match_sql(rules) -> str:
    return FLOW + f"""
SELECT k, {duck.membership('sa', rules)} AS sa_sensitive, {duck.membership('da', rules)} AS da_sensitive
FROM flow"""


def _match_query(rules, plan):
    def run(spark, sf_dir):
        p = parsed_flows(spark, sf_dir).select("k", "sa", "da")
        policy = pol.read_policy(spark, lines=rules)
        p = pol.match_policy(p, "sa", policy, plan=plan)
        p = pol.match_policy(p, "da", policy, plan=plan)
        return p.select("k", "sa_sensitive", "da_sensitive")

    return run


for _name, _rules in MATCH_CASES.items():
    register(_name, _match_sql(_rules))(_match_query(_rules, "auto"))

# M8: any rule, by two physical plans that must agree (tests add the nested-loop one on small data)
for _plan in ("or", "bucket"):
    register(f"policy_match_any_{_plan}", _match_sql(ANY_POLICY))(_match_query(ANY_POLICY, _plan))


# M8 with rules made from the customers, so that the policy grows with the data: subnets of all widths from /18
# on, and ranges, over the sources' networks; wide ranges of the IPv6 destinations' network besides.
# two thirds of the flows with a target in or beside the default policy's networks
_DEFAULT_CELLS = "CASE WHEN k % 3 = 0 THEN concat('192.168.1.', CAST(k % 256 AS {s})) WHEN k % 3 = 1 THEN concat('10.0.19.', CAST(k % 256 AS {s})) ELSE da END"


@register(
    "policy_match_default",
    FLOW + f""", moved AS (SELECT k, {_DEFAULT_CELLS.format(s='VARCHAR')} AS ip FROM flow)
SELECT k, ip, {duck.membership('ip', ('192.168.1.0,192.168.1.254', '10.0.19.0,10.0.19.254'))} AS ip_sensitive FROM moved""",
)
def policy_match_default(spark, sf_dir):
    """The built-in default policy, on addresses in and around its networks."""
    p = parsed_flows(spark, sf_dir).selectExpr("k", f"{_DEFAULT_CELLS.format(s='STRING')} AS ip")
    return pol.match_policy(p, "ip", pol.read_policy(spark, default=True))


_RULE_EXPR = """CASE c_custkey % 4
  WHEN 0 THEN concat('10.', c_custkey % 256, '.', (c_custkey * 7) % 256, '.', (c_custkey * 31) % 256, '/', 18 + (c_custkey * 13) % 15)
  WHEN 1 THEN concat('192.168.10.', (c_custkey * 11) % 256)
  WHEN 2 THEN concat('10.10.', (c_custkey * 3) % 120, '.', (c_custkey * 17) % 256, ',10.10.', (c_custkey * 3) % 120, '.', (c_custkey * 17 + c_custkey % 5) % 256)
  ELSE concat('2001:db8::', (c_custkey * 5) % 8, '00:0,2001:db8::', (c_custkey * 5) % 8, '00:', c_custkey % 10000) END"""

_MANY_RULES_SQL = FLOW + f"""
, rule AS (SELECT c_custkey AS c, {_RULE_EXPR} AS rule FROM customer),
bound AS (
  SELECT c, CASE WHEN contains(rule, '/') THEN split_part(rule, '/', 1) ELSE split_part(rule, ',', 1) END AS a,
    CASE WHEN contains(rule, ',') THEN split_part(rule, ',', 2) ELSE split_part(rule, '/', 1) END AS b,
    CASE WHEN contains(rule, '/') THEN CAST(split_part(rule, '/', 2) AS INTEGER) END AS bits
  FROM rule),
v4 AS (
  SELECT CASE WHEN bits IS NULL THEN least({duck.v4_num('a')}, {duck.v4_num('b')}) ELSE ({duck.v4_num('a')} >> (32 - bits) << (32 - bits)) + 1 END AS lo,
    CASE WHEN bits IS NULL THEN greatest({duck.v4_num('a')}, {duck.v4_num('b')})
         ELSE ({duck.v4_num('a')} >> (32 - bits) << (32 - bits)) + (1::BIGINT << (32 - bits)) - 2 END AS hi
  FROM bound WHERE NOT contains(a, ':')),
v6 AS (SELECT least({duck.v6_hex('a')}, {duck.v6_hex('b')}) AS lo, greatest({duck.v6_hex('a')}, {duck.v6_hex('b')}) AS hi FROM bound WHERE contains(a, ':')),
address AS (SELECT sa AS ip FROM flow UNION SELECT da FROM flow),
hit AS (
  SELECT ip FROM address JOIN v4 ON {duck.v4_num('ip')} BETWEEN lo AND hi
  UNION SELECT ip FROM address JOIN v6 ON {duck.v6_hex('ip')} BETWEEN lo AND hi)
SELECT k, sa IN (SELECT ip FROM hit) AS sa_sensitive, da IN (SELECT ip FROM hit) AS da_sensitive FROM flow"""


def _many_rules(spark, sf_dir):
    path = scratch_path(spark, "policy-rules")
    fixtures.table(spark, sf_dir, "customer").selectExpr(f"{_RULE_EXPR} AS value").write.text(path)
    return pol.read_policy(spark, path)


def _match_many(spark, sf_dir, **limits):
    p = parsed_flows(spark, sf_dir).select("k", "sa", "da")
    policy = _many_rules(spark, sf_dir)
    for c in ("sa", "da"):
        p = pol.match_policy(p, c, policy, plan="prefix", **limits)
    return p.select("k", "sa_sensitive", "da_sensitive")


@register("policy_match_prefixes", _MANY_RULES_SQL)
def policy_match_prefixes(spark, sf_dir):
    """M8: a policy file with a rule for each customer, by prefixes of all lengths and broadcast equality joins."""
    return _match_many(spark, sf_dir)


@register("policy_match_prefixes_shuffled", _MANY_RULES_SQL)
def policy_match_prefixes_shuffled(spark, sf_dir):
    """M8: the same above the broadcast limit: distinct addresses meet the prefixes in a shuffle join."""
    return _match_many(spark, sf_dir, max_broadcast_rows=0)


def _policy(spark):
    return pol.read_policy(spark, lines=POLICY)


_SENSITIVE_CELLS = f"""
cells AS (SELECT trim(sa) AS ip FROM flow UNION ALL SELECT trim(da) AS ip FROM flow),
sensitive AS (
  SELECT ip AS original_ip, CASE WHEN contains(ip, ':') THEN 6 ELSE 4 END AS family, count(*) AS n_cells
  FROM cells WHERE {duck.membership('ip', POLICY)} GROUP BY ip
)"""


@register("sensitive_ips", with_cte(FLOW_CTE, _SENSITIVE_CELLS) + "SELECT original_ip, family, n_cells FROM sensitive")
def sensitive_ips(spark, sf_dir):
    """The distinct addresses that need a pseudonym, with their cell counts."""
    p = parsed_flows(spark, sf_dir)
    return anon.sensitive_ips(p, COLS, _policy(spark))


# A stand-in mapping for the oracle-checked queries: DuckDB has no AES, so the
# apply/audit operators are checked with a hash-derived mapping table built
# by the same Spark job shape (distinct sensitive addresses -> pseudonym).
# It is written before it is used: its rows are counted and joined twice.
def _hash_mapping(ips):
    return anon.materialize(ips.select(
        "original_ip",
        F.concat(F.lit("anon-"), F.substring(F.sha2("original_ip", 256), 1, 12)).alias("obfuscated_ip"),
        "family",
        "n_cells",
    ))


def _hash_sql(x: str) -> str:
    return f"concat('anon-', substr(sha256(trim({x})), 1, 12))"


def _anon_sql(x: str) -> str:
    return f"CASE WHEN {duck.membership(x, POLICY)} THEN {_hash_sql(x)} ELSE {x} END"


@register("anonymize_with_mapping", FLOW + f"SELECT k, {_anon_sql('sa')} AS sa, {_anon_sql('da')} AS da FROM flow")
def anonymize_with_mapping(spark, sf_dir):
    """A1 A2 M9: sensitive cells replaced through a mapping table, others unchanged."""
    p = parsed_flows(spark, sf_dir)
    policy = _policy(spark)
    mapping = _hash_mapping(anon.sensitive_ips(p, COLS, policy))
    return anon.apply_mapping(p, COLS, mapping, policy=policy, unique=True).select("k", "sa", "da")


_UNMAPPED_SQL = (
    with_cte(FLOW_CTE, _SENSITIVE_CELLS.replace("SELECT trim(sa) AS ip FROM flow UNION ALL SELECT trim(da) AS ip FROM flow",
                                                "SELECT trim(sa) AS ip FROM flow")) + f"""
SELECT k, {_anon_sql('sa')} AS sa,
  CASE WHEN {duck.membership('da', POLICY)} THEN
       CASE WHEN trim(da) IN (SELECT original_ip FROM sensitive) THEN {_hash_sql('da')} END
       ELSE da END AS da
FROM flow"""
)


@register("anonymize_unmapped_null", _UNMAPPED_SQL)
def anonymize_unmapped_null(spark, sf_dir):
    """A sensitive cell with no mapping never passes in clear: it becomes NULL."""
    p = parsed_flows(spark, sf_dir)
    policy = _policy(spark)
    mapping = _hash_mapping(anon.sensitive_ips(p, ["sa"], policy))
    return anon.apply_mapping(p, COLS, mapping, policy=policy, unique=True).select("k", "sa", "da")


@register("anonymize_partial_shuffled", _UNMAPPED_SQL)
def anonymize_partial_shuffled(spark, sf_dir):
    """A2: a partial mapping over the broadcast limit gives the same cells, also with the key at hand."""
    p = parsed_flows(spark, sf_dir)
    policy = _policy(spark)
    mapping = _hash_mapping(anon.sensitive_ips(p, ["sa"], policy))
    out = anon.apply_mapping(p, COLS, mapping, policy=policy, key=SAMPLE_KEY, unique=True, max_broadcast_rows=1)
    return out.select("k", "sa", "da")


@register(
    "anonymize_audit",
    with_cte(FLOW_CTE, _SENSITIVE_CELLS)
    + f"SELECT original_ip, {_hash_sql('original_ip')} AS obfuscated_ip, 'anonymized' AS result, n_cells FROM sensitive",
)
def anonymize_audit(spark, sf_dir):
    """K8: one audit row per looked-up address."""
    p = parsed_flows(spark, sf_dir)
    return anon.audit(_hash_mapping(anon.sensitive_ips(p, COLS, _policy(spark))))


@register(
    "anonymize_then_features_hashmap",
    FLOW + f"SELECT k, {_anon_sql('sa')} AS sa, {_anon_sql('da')} AS da," + FEATURES_SQL + "\nFROM flow WHERE dp <> ''",
)
def anonymize_then_features_hashmap(spark, sf_dir):
    """A7 with the stand-in mapping: anonymized cells and derived features together."""
    p = flowop.good_rows(parsed_flows(spark, sf_dir))
    policy = _policy(spark)
    mapping = _hash_mapping(anon.sensitive_ips(p, COLS, policy))
    out = feat.add_features(anon.apply_mapping(p, COLS, mapping, policy=policy, unique=True))
    return out.select("k", "sa", "da", *schemas.DERIVED_COLUMNS)


def cryptopan_mapping(spark, parsed, policy=None):
    """Crypto-PAn mapping of the sensitive addresses, materialized in the checkpoint folder."""
    policy = policy if policy is not None else _policy(spark)
    return anon.materialize(anon.build_mapping(anon.sensitive_ips(parsed, COLS, policy), SAMPLE_KEY))


@register("anonymize_then_features")
def anonymize_then_features(spark, sf_dir):
    """Flagship (A1-A4, A7, F1-F14, P6): Crypto-PAn anonymized 62-cell records."""
    p = flowop.good_rows(parsed_flows(spark, sf_dir))
    policy = _policy(spark)
    mapping = cryptopan_mapping(spark, p, policy)
    # the mapping covers every sensitive cell of these rows, so no policy re-check per cell
    out = feat.add_features(anon.apply_mapping(p, COLS, mapping, unique=True))
    columns = schemas.flow_columns() + list(schemas.DERIVED_COLUMNS)
    return out.select("k", "sa", "da", *schemas.DERIVED_COLUMNS, flowop.to_flow_line(out, columns).alias("line"))


@register("build_mapping")
def build_mapping(spark, sf_dir):
    """A3 A4: the reversible mapping table of the sensitive addresses."""
    p = parsed_flows(spark, sf_dir)
    return anon.build_mapping(anon.sensitive_ips(p, COLS, _policy(spark)), SAMPLE_KEY)


@register("cryptopan_v4")
def cryptopan_v4(spark, sf_dir):
    """A4 on every distinct IPv4 source address of the flows."""
    p = parsed_flows(spark, sf_dir)
    ips = p.select(F.trim("sa").alias("original_ip")).distinct()
    return anon.build_mapping(ips, SAMPLE_KEY)


@register("cryptopan_v6")
def cryptopan_v6(spark, sf_dir):
    """A4 on every distinct IPv6 destination address of the flows."""
    p = parsed_flows(spark, sf_dir)
    ips = p.select(F.trim("da").alias("original_ip")).filter(F.instr("original_ip", ":") > 0).distinct()
    return anon.build_mapping(ips, SAMPLE_KEY)


@register("deanonymize", FLOW + "SELECT k, sa, da FROM flow")
def deanonymize(spark, sf_dir):
    """A5: anonymize with Crypto-PAn, then map back; equals the original flows."""
    p = parsed_flows(spark, sf_dir)
    mapping = cryptopan_mapping(spark, p)
    anonymized = anon.apply_mapping(p, COLS, mapping, unique=True, flag=True)
    return anon.deanonymize(anonymized, COLS, mapping).select("k", "sa", "da")


# IPv6 addresses come back in canonical text; of the sensitive ones only ...::0 is written otherwise
_BY_KEY_SQL = FLOW + "SELECT k, sa, CASE WHEN da = 'fddd:be2e:c6ba::0' THEN 'fddd:be2e:c6ba::' ELSE da END AS da FROM flow"


@register("deanonymize_by_key", _BY_KEY_SQL)
def deanonymize_by_key(spark, sf_dir):
    """A5: flagged pseudonyms are decrypted by the key; the mapping is not used to go back."""
    p = parsed_flows(spark, sf_dir)
    anonymized = anon.apply_mapping(p, COLS, cryptopan_mapping(spark, p), unique=True, flag=True)
    return anon.deanonymize_by_key(anonymized, COLS, key=SAMPLE_KEY).select("k", "sa", "da")


@register("deanonymize_by_key_and_policy", _BY_KEY_SQL)
def deanonymize_by_key_and_policy(spark, sf_dir):
    """A5: records without flags; what decrypts to a sensitive address is a pseudonym (no clear address of these flows does)."""
    p = parsed_flows(spark, sf_dir)
    policy = _policy(spark)
    anonymized = anon.apply_mapping(p, COLS, cryptopan_mapping(spark, p, policy), unique=True)
    return anon.deanonymize_by_key(anonymized, COLS, key=SAMPLE_KEY, policy=policy).select("k", "sa", "da")


def _store_batches(spark, sf_dir, store):
    """The flows in three batches of two runs, the second replayed, as a stream would bring them; compacted in between."""
    p = parsed_flows(spark, sf_dir)
    policy = _policy(spark)
    for batch, part in (("a-0", 0), ("a-1", 1), ("a-1", 1), ("b-0", 2)):
        store.add(anon.sensitive_ips(p.filter(F.col("k") % 3 == part), COLS, policy), batch)
        if batch == "a-1":
            store.compact()


@register(
    "mapping_store_batches",
    with_cte(FLOW_CTE) + f"""
, cell AS (SELECT k % 3 AS part, trim(sa) AS ip FROM flow UNION ALL SELECT k % 3, trim(da) FROM flow)
SELECT ip AS original_ip, CASE WHEN contains(ip, ':') THEN 6 ELSE 4 END AS family,
  CASE min(part) WHEN 0 THEN 'a-0' WHEN 1 THEN 'a-1' ELSE 'b-0' END AS first_batch, true AS as_one_batch
FROM cell WHERE {duck.membership('ip', POLICY)} GROUP BY ip""",
)
def mapping_store_batches(spark, sf_dir):
    """A2 A3: a mapping kept over batches, a replay, a compaction and a second run: each address once, as one batch maps it."""
    root = scratch_path(spark, "mapping-store")
    _store_batches(spark, sf_dir, MappingStore(spark, root, SAMPLE_KEY, n_buckets=4))
    whole = build_mapping(spark, sf_dir).select("original_ip", F.col("obfuscated_ip").alias("want"))
    got = MappingStore(spark, root, SAMPLE_KEY).read().join(whole, "original_ip", "left")
    return got.select("original_ip", "family", "first_batch", F.coalesce(F.col("want") == F.col("obfuscated_ip"), F.lit(False)).alias("as_one_batch"))


@register("anonymize_then_features_checked", FLOW + "SELECT k, sa, da," + FEATURES_SQL + "\nFROM flow WHERE dp <> ''")
def anonymize_then_features_checked(spark, sf_dir):
    """The flagship's features, with its addresses put back through the mapping."""
    p = flowop.good_rows(parsed_flows(spark, sf_dir))
    mapping = cryptopan_mapping(spark, p)
    out = feat.add_features(anon.apply_mapping(p, COLS, mapping, unique=True, flag=True))
    return anon.deanonymize(out, COLS, mapping).select("k", "sa", "da", *schemas.DERIVED_COLUMNS)


def _v4_number(ip: str, part) -> str:
    return " + ".join(f"CAST({part(ip, i)} AS BIGINT) * {256 ** (3 - i)}" for i in range(4))


def _shared_bits(a: str, b: str, xor) -> str:
    return f"CASE WHEN {a} = {b} THEN 32 ELSE 32 - length(bin({xor(a, b)})) END"


@register(
    "cryptopan_v4_prefixes",
    FLOW + f"""
, ips AS (SELECT DISTINCT trim(sa) AS ip FROM flow),
n AS (SELECT ip, {_v4_number('ip', lambda c, i: f"split_part({c}, '.', {i + 1})")} AS a FROM ips),
g AS (SELECT a // 65536 AS net, min(a) AS first FROM n GROUP BY 1)
SELECT ip AS original_ip, CAST({_shared_bits('a', 'first', lambda a, b: f'xor({a}, {b})')} AS INTEGER) AS shared, true AS preserved
FROM n JOIN g ON n.a // 65536 = g.net""",
)
def cryptopan_v4_prefixes(spark, sf_dir):
    """A4: an address shares as many leading bits with the first of its /16 as their pseudonyms share."""
    m = anon.materialize(cryptopan_v4(spark, sf_dir).select("original_ip", "obfuscated_ip"))
    part = lambda c, i: f"split({c}, '[.]')[{i}]"
    n = m.selectExpr("original_ip", f"{_v4_number('original_ip', part)} AS a", f"{_v4_number('obfuscated_ip', part)} AS b")
    n = n.withColumn("net", F.expr("a div 65536"))
    first = n.groupBy("net").agg(F.min(F.struct("a", "b")).alias("f")).select("net", F.col("f.a").alias("fa"), F.col("f.b").alias("fb"))
    both = n.join(first, "net")
    shared, out = (_shared_bits(x, y, lambda p, q: f"{p} ^ {q}") for x, y in (("a", "fa"), ("b", "fb")))
    return both.selectExpr("original_ip", f"{shared} AS shared", f"{shared} = {out} AS preserved")


@register(
    "build_mapping_keys",
    with_cte(FLOW_CTE, _SENSITIVE_CELLS) + "SELECT original_ip, family, n_cells, true AS one_to_one FROM sensitive",
)
def build_mapping_keys(spark, sf_dir):
    """A3: every sensitive address has one pseudonym of its own family, and no two share one."""
    m = anon.materialize(build_mapping(spark, sf_dir))
    used = m.groupBy("obfuscated_ip").agg(F.count(F.lit(1)).alias("n"))
    same = F.when(F.instr("obfuscated_ip", ":") > 0, 6).otherwise(4) == F.col("family")
    return m.join(used, "obfuscated_ip").select("original_ip", "family", "n_cells", ((F.col("n") == 1) & same).alias("one_to_one"))


def _same_pseudonyms(spark, sf_dir, mapping):
    """The mapping's keys, and whether its pseudonyms are those that one address after the other has under the key's bytes."""
    whole = build_mapping(spark, sf_dir).select("original_ip", F.col("obfuscated_ip").alias("want"))
    same = F.coalesce(F.col("want") == F.col("obfuscated_ip"), F.lit(False)).alias("same")
    return mapping.join(whole, "original_ip", "left").select("original_ip", "family", "n_cells", same)


_SAME_SQL = with_cte(FLOW_CTE, _SENSITIVE_CELLS) + "SELECT original_ip, family, n_cells, true AS same FROM sensitive"


@register("build_mapping_key_file", _SAME_SQL)
def build_mapping_key_file(spark, sf_dir):
    """A3 A4: the key stays in a file that the executors read; no plan holds it."""
    key = write_key_file(spark, scratch_path(spark, "cryptopan-key"), SAMPLE_KEY)
    ips = anon.sensitive_ips(parsed_flows(spark, sf_dir), COLS, _policy(spark))
    return _same_pseudonyms(spark, sf_dir, anon.materialize(anon.build_mapping(ips, key)))


@register("build_mapping_by_prefixes", _SAME_SQL)
def build_mapping_by_prefixes(spark, sf_dir):
    """A3 A4: one AES call for each distinct prefix of the addresses, the key in a file."""
    key = write_key_file(spark, scratch_path(spark, "cryptopan-key"), SAMPLE_KEY)
    ips = anon.sensitive_ips(parsed_flows(spark, sf_dir), COLS, _policy(spark))
    return _same_pseudonyms(spark, sf_dir, prefix_cipher.build_mapping_by_prefixes(ips, key))


_ALL_ADDRESSES = "SELECT trim(sa) AS ip FROM flow UNION SELECT trim(da) FROM flow"


@register(
    "cryptopan_prefix_calls",
    FLOW + f"""
, address AS (SELECT DISTINCT CASE WHEN contains(ip, ':') THEN {duck.v6_hex('ip')} ELSE printf('%08x', {duck.v4_num('ip')}) END AS h
              FROM ({_ALL_ADDRESSES})),
bits AS (SELECT array_to_string(list_transform(range(1, len(h) + 1),
           lambda i: lpad(bin(strpos('0123456789abcdef', substr(h, i, 1)) - 1), 4, '0')), '') AS b FROM address),
prefix AS (SELECT DISTINCT substr(b, 1, n) AS p FROM (SELECT b, unnest(range(0, len(b))) AS n FROM bits))
SELECT CAST(len(p) // 16 AS INTEGER) AS level, count(*) AS n_calls FROM prefix GROUP BY 1""",
)
def cryptopan_prefix_calls(spark, sf_dir):
    """A4: the AES calls by level of 16 bits: as many as the flows' addresses have distinct prefixes."""
    p = parsed_flows(spark, sf_dir)
    ips = p.select(F.explode(F.array(F.trim("sa"), F.trim("da"))).alias("ip")).distinct()
    done = prefix_cipher.encrypted_words(prefix_cipher.words(prefix_cipher.keyed(ips, "ip")), SAMPLE_KEY)
    level = F.expr("cast(length(parent) div 4 as int)").alias("level")
    return done.groupBy(level).agg(F.sum("n_calls").cast("bigint").alias("n_calls"))
