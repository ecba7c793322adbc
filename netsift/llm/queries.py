"""Registered queries of the llm operators; ``__spark_entry__.py`` adds them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netsift.llm.byte_bpe import encode_digests
from netsift.llm.collocations import collocations
from netsift.llm.common import table
from netsift.llm.embedding_dedup import embedding_groups
from netsift.llm.exact_dedup import exact_dedup
from netsift.llm.html_text import extract_text
from netsift.llm.line_dedup import line_digests
from netsift.llm.merkle import merkle_manifest
from netsift.llm.packing import pack_documents
from netsift.llm.quality import fit_quality, grade_documents
from netsift.llm.quality_rules import quality_rules
from netsift.llm.simhash_dedup import simhash_groups
from netsift.llm.suffix_dedup import repeat_digests
from netsift.llm.toxicity import fit_toxicity, score_documents

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return wrap


OP2_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
"""


@query("op2_exact_dedup", OP2_SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query("op1_simhash_dedup")
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
owner AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT k.*, coalesce(o.first < k.doc_id, false) AS gone FROM keyed k LEFT JOIN owner o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op7_line_dedup", OP7_SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(table(spark, sf_dir, "documents"))


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


@query("op3_html_text")
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query("op5_embedding_dedup")
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return grade_documents(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


# crc32 bit by bit over the decimal digits; levels and the way up as recursive queries
OP11_SQL = r"""
WITH RECURSIVE
fields AS (
  SELECT doc_id, source, text, concat(
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 5 = 0 AS bend
  FROM documents),
leaves AS (
  SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN bend THEN sha256(head || coalesce(strlen(text) || ':' ||
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS bent
  FROM fields),
low(source, l, i, h, n) AS (
  SELECT source, 0, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1, leaf, count(*) OVER (PARTITION BY source) FROM leaves
  UNION ALL
  SELECT source, l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), max((n + 15) // 16) FROM low WHERE n > 1 GROUP BY source, l, i // 16),
subs AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high(l, i, h, n) AS (
  SELECT 0, i, h, n FROM subs
  UNION ALL
  SELECT l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), max((n + 15) // 16) FROM high WHERE n > 1 GROUP BY l, i // 16),
kin AS (
  SELECT source, l, i // 16 AS u, list(h ORDER BY i) AS kids FROM low WHERE n > 1 GROUP BY ALL),
top_kin AS (SELECT l, i // 16 AS u, list(h ORDER BY i) AS kids FROM high WHERE n > 1 GROUP BY ALL),
up(source, place, doc_id, l, i, leaf, fold, proof) AS (
  SELECT a.source, a.i, b.doc_id, 0, a.i, b.leaf, coalesce(b.bent, b.leaf), ''
  FROM (SELECT source, i FROM low WHERE l = 0) a
  JOIN (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves) b
    ON a.source IS NOT DISTINCT FROM b.source AND a.i = b.i
  UNION ALL
  SELECT c.source, place, doc_id, c.l + 1, c.u, leaf, sha256(a || fold || z), proof || a || z
  FROM (SELECT up.*, k.u, array_to_string(k.kids[1 : up.i % 16], '') AS a, array_to_string(k.kids[up.i % 16 + 2 :], '') AS z
        FROM up JOIN kin k ON up.source IS NOT DISTINCT FROM k.source AND up.l = k.l AND up.i // 16 = k.u) c),
top_up(source, place, doc_id, l, i, leaf, subroot, fold, proof) AS (
  SELECT up.source, place, doc_id, 0, s.i, leaf, s.h, fold, proof
  FROM up JOIN subs s ON up.source IS NOT DISTINCT FROM s.source
  WHERE up.l = (SELECT max(l) FROM low WHERE low.source IS NOT DISTINCT FROM up.source)
  UNION ALL
  SELECT c.source, place, doc_id, c.l + 1, c.u, leaf, subroot, sha256(a || fold || z), proof || a || z
  FROM (SELECT t.*, k.u, array_to_string(k.kids[1 : t.i % 16], '') AS a, array_to_string(k.kids[t.i % 16 + 2 :], '') AS z
        FROM top_up t JOIN top_kin k ON t.l = k.l AND t.i // 16 = k.u) c)
SELECT doc_id, leaf, subroot, r.root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = r.root AS verified
FROM top_up, (SELECT h AS root FROM high WHERE n = 1) r
WHERE l = (SELECT max(l) FROM high)
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i : i + k - 1])) AS p
  FROM worded, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, array_to_string(p, ' ') AS phrase, any_value(p) AS ws, count(*) AS c FROM runs GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(c) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k > 1 AND c >= 30),
covered AS (
  SELECT DISTINCT a.lang, a.phrase FROM cand a JOIN cand b ON a.lang = b.lang AND b.k > a.k
    AND contains(' ' || b.phrase || ' ', ' ' || a.phrase || ' ') AND 100 * b.c >= 80 * a.c),
cuts AS (
  SELECT a.lang, a.phrase, a.c AS a, x.c AS l, y.c AS r, i.k, (2000000::HUGEINT * a.c) // (x.c + y.c) AS score
  FROM (SELECT * FROM cand ANTI JOIN covered USING (lang, phrase)) a
  JOIN (SELECT unnest([1, 2, 3]) AS k) i ON i.k < a.k
  JOIN f x ON x.lang = a.lang AND x.phrase = array_to_string(a.ws[1 : i.k], ' ')
  JOIN f y ON y.lang = a.lang AND y.phrase = array_to_string(a.ws[i.k + 1 :], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op12_collocations", OP12_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query("op13_quality_rules")
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
