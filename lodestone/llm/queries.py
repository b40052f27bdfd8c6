"""The ``opN_*`` queries: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, common, conversations, exact, langid, lines, minhash, packing, simhash, suffixes, topk, toxicity, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


@query("op10_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(common.read(spark, sf_dir, "documents"))


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.read(spark, sf_dir, "documents"))


@query("op5_bpe_tokenization")
def op5_bpe_tokenization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(common.read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op2_warc_revisits", """
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
first AS (SELECT payload_digest, max(page_id) AS first_id FROM hashed WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM hashed LEFT JOIN first USING (payload_digest)
""")
def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (warc.archived(common.read(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@query("op9_exact_top_k", """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(common.read(spark, sf_dir, "embeddings"))


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(common.read(spark, sf_dir, "documents"))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_suffix_array_dedup", """
WITH bytes AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (SELECT r, unnest(range(n - 199)) AS i, h FROM bytes WHERE n >= 200),
hashed AS (SELECT r, i, md5_number(h[i + 1:i + 200]) AS s FROM starts),
hit AS (SELECT r, i FROM hashed WHERE s IN (SELECT s FROM hashed GROUP BY s HAVING count(*) > 1)),
run AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM hit),
numbered AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS k FROM run),
span AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY r, k),
cut AS (SELECT r, a, b, lead(a) OVER (PARTITION BY r ORDER BY a) AS next_a, row_number() OVER (PARTITION BY r ORDER BY a) AS k FROM span),
piece AS (
  SELECT r, 0 AS k, h[1:coalesce(a, n)] AS kept, 0 AS gone, 0 AS spans FROM bytes LEFT JOIN (SELECT r, min(a) AS a FROM span GROUP BY r) USING (r)
  UNION ALL SELECT r, k, h[b + 1:coalesce(next_a, n)], b - a, 1 FROM cut JOIN bytes USING (r)),
whole AS (SELECT r, string_agg(hex(kept), '' ORDER BY k) AS kept, sum(gone)::BIGINT AS n_removed, sum(spans)::BIGINT AS n_spans FROM piece GROUP BY r)
SELECT doc_id, n::BIGINT AS n_bytes, n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256 FROM bytes JOIN whole USING (r)
""")
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(common.read(spark, sf_dir, "documents"))


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_duplicates(common.read(spark, sf_dir, "documents"))


@query("op4_toxicity_severity")
def op4_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, common.read(spark, sf_dir, "labels")))


@query("op11_minhash_near_dedup", r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingled AS (
    SELECT doc_id, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS s
    FROM worded),
class AS (SELECT s, len(s) AS n, min(doc_id) AS least, row_number() OVER () AS cid FROM shingled GROUP BY s),
each AS (SELECT cid, n, unnest(s) AS x FROM class),
link AS (
    SELECT a.cid AS u, b.cid AS v FROM each a JOIN each b ON a.x = b.x AND a.cid <> b.cid
    GROUP BY a.cid, b.cid, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(cid, other) AS (SELECT cid, cid FROM class UNION SELECT r.cid, l.v FROM reach r JOIN link l ON r.other = l.u),
component AS (SELECT r.cid, min(c.least) AS component_id FROM reach r JOIN class c ON r.other = c.cid GROUP BY r.cid),
labelled AS (
    SELECT d.doc_id, c.n AS n_shingles, CASE WHEN c.n = 0 THEN d.doc_id ELSE component_id END AS component_id
    FROM shingled d JOIN class c USING (s) JOIN component USING (cid))
SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM labelled
""")
def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(common.read(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(common.read(spark, sf_dir, "embeddings"))


@query("op13_conversation_repair", r"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) AS r(i)),
given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
kinds AS (
    SELECT conv_id, turn, role, text,
           xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)),
                                       lambda h, b: xor(t[(xor(h, b) & 255) + 1], h >> 8))) % 20 AS kind
    FROM given, crc_table),
harmed AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM kinds WHERE kind <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM harmed),
faulty AS (
    SELECT *, left(role, 1) AS initial,
           CASE WHEN trimmed = '' THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'right' END AS fault,
           left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS meeting
    FROM placed),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (meeting NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM faulty GROUP BY conv_id),
-- state 0: nothing yet, 1: after s, 2: after u, 3: after a
step(q, initial, onward) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
given_role(q, onward) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
-- one insertion at a place is enough: two in a row lead nowhere that costs less
path(conv_id, i, q, best) AS (
    SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': ''} FROM counted
    UNION ALL
    SELECT conv_id, i, q, min(best) FROM (
        SELECT p.conv_id, f.i, e.q, {'cost': p.best.cost + e.cost, 'audit': p.best.audit || e.audit} AS best
        FROM (SELECT conv_id, i, q, best FROM path
              UNION ALL SELECT conv_id, i, g.onward, {'cost': best.cost + 5, 'audit': best.audit || 'I'} FROM path JOIN given_role g USING (q)) p
        JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1,
        LATERAL (SELECT p.q AS q, 2 AS cost, 'D' AS audit
                 UNION ALL SELECT s.onward, CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END, 'K' FROM step s
                 WHERE s.q = p.q AND s.initial = f.initial AND f.fault NOT IN ('blank', 'duplicate')
                 UNION ALL SELECT g.onward, CASE WHEN f.fault = 'truncated' THEN 6 ELSE 1 END, 'R' FROM given_role g
                 WHERE g.q = p.q AND f.fault NOT IN ('blank', 'duplicate')) e)
    GROUP BY conv_id, i, q),
ended AS (
    SELECT conv_id, min(CASE WHEN q IN (0, 3) THEN best ELSE {'cost': best.cost + 5, 'audit': best.audit || 'I'} END) AS best
    FROM path JOIN counted USING (conv_id) WHERE i = n AND q <> 1 GROUP BY conv_id),
edits AS (SELECT conv_id, best.audit AS audit, unnest(range(1, len(best.audit) + 1)) AS spot FROM ended),
numbered AS (
    SELECT conv_id, spot, audit[spot] AS edit, len(replace(left(audit, spot::INT), 'I', '')) AS i, len(replace(left(audit, spot::INT), 'D', '')) AS place FROM edits),
stays AS (
    SELECT e.*, f.role, f.text, max(CASE WHEN place = 1 AND edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led
    FROM numbered e LEFT JOIN faulty f ON f.conv_id = e.conv_id AND f.i = e.i AND e.edit <> 'I' WHERE edit <> 'D'),
told AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
                               || ':' || coalesce(text, ''), chr(10) ORDER BY spot) AS repaired FROM stays GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counted USING (conv_id) LEFT JOIN ended USING (conv_id) LEFT JOIN told USING (conv_id)
""")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_after_damage(common.read(spark, sf_dir, "conversations"))
