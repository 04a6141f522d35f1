"""One query per operator, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.llm import (
    alignment, ctw, minhash, mixing, packing, quality, revisits, secret_scan, substrings, syncmers, token_counts, topk, trie,
)
from clicktide.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per line of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op5_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's revisit; headers as sorted ``name=value`` text."""
    found = revisits.resolve(revisits.captures_of(table(spark, sf_dir, "pages")))
    pairs = F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.withColumn("headers", F.array_join(F.array_sort(pairs), ";"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document, by the checksum of its id, is held out of the training."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return ctw.score_documents(docs, held_out)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    counts = [
        F.size(F.filter("known", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")
        for rank, kind in enumerate(secret_scan.kinds_of_patterns())]
    every = F.array_sort(F.concat("known", "added"))
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.listed(F.col("known")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(every).alias("spans"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))[0]


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def queries() -> dict[str, Query]:
    return {
        "op1_retrieval_packing": op1_retrieval_packing,
        "op2_token_counts": op2_token_counts,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_minhash_near_dedup": op4_minhash_near_dedup,
        "op5_syncmer_fingerprints": op5_syncmer_fingerprints,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_source_mixing": op7_source_mixing,
        "op8_revisit_resolution": op8_revisit_resolution,
        "op9_exact_top_k": op9_exact_top_k,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_secret_scan": op11_secret_scan,
        "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
        "op13_conversation_prefix_trie": op13_conversation_prefix_trie,
    }


_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR_DEDUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept
FROM m LEFT JOIN n ON n.doc_id = m.doc_id"""

_SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN rep USING (k)),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p)
         GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * cast(x AS double))) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, cast(list_dot_product(q.x, c.x) AS bigint) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS integer) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

_URL = "'^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)([?][^#]*)?(#.*)?$'"
_REVISITS = f"""
WITH p AS (SELECT page_id, trim(url) AS u, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, regexp_extract(u, {_URL}, 1) AS host, regexp_replace(regexp_extract(u, {_URL}, 2), '/+$', '') AS path,
             substr(regexp_extract(u, {_URL}, 3), 2) AS query FROM p),
c AS (SELECT *, CASE WHEN regexp_matches(u, {_URL}) THEN
          lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            host, '^.*@', ''), '^(?i)www[0-9]*[.]', ''), ':(80|443)?$', ''), '[.]$', ''))
          || CASE WHEN path = '' THEN '/' ELSE path END
          || CASE WHEN query = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split(query, '&')), '&') END
        ELSE u END AS url,
        '"' || md5(html) || '"' AS tag, 'day ' || length(html) AS day, page_id * 60 AS first,
        page_id * 60 + 30 + (page_id % 5) * 36000 AS again FROM h),
m AS (SELECT r.page_id, max(row(f.first, f.page_id)) AS best FROM c r JOIN c f ON f.url = r.url AND f.first < r.again
      GROUP BY r.page_id),
j AS (SELECT r.page_id, r.url, f.page_id AS stored, f.tag AS stored_tag, f.day AS stored_day, f.html AS stored_html,
             CASE r.page_id % 4 WHEN 3 THEN NULL WHEN 2 THEN '"' || r.page_id || '"' WHEN 1 THEN 'W/' || r.tag
               ELSE r.tag END AS sent_tag,
             CASE WHEN r.page_id % 4 = 3 THEN r.day END AS sent_day
      FROM c r LEFT JOIN m ON m.page_id = r.page_id LEFT JOIN c f ON f.page_id = m.best[2]),
o AS (SELECT *, CASE WHEN stored IS NULL THEN 'no_response'
        WHEN coalesce(regexp_replace(sent_tag, '^W/', '') = stored_tag, sent_day = stored_day) THEN 'resolved'
        ELSE 'mismatch' END AS outcome FROM j)
SELECT page_id * 2 + 1 AS record_id, url, stored * 2 AS response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN sha256(stored_html) END AS digest,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=120;content-length=' || strlen(stored_html)
         || ';content-type=text/html;etag=' || coalesce(sent_tag, stored_tag)
         || ';last-modified=' || coalesce(sent_day, stored_day) END AS headers
FROM o"""




def _matches_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """Rows (doc, rank, kind, a, b, s): a match from code point a to b, s its group."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
SELECT doc, {rank} AS rank, '{kind}' AS kind, b - len(f[i]) AS a, b, s[i] AS s FROM (
  SELECT *, cast(list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(f[1:i], lambda x: length(x)))
            AS bigint) AS b
  FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM (
    SELECT doc, regexp_extract_all(t, {quoted}) AS f, regexp_extract_all(t, {quoted}, {group}) AS s,
           string_split_regex(t, {quoted}) AS g FROM d)))
WHERE length(s[i]) >= {least}"""


def _secrets_sql() -> str:
    known = " UNION ALL ".join(
        _matches_sql(kind, rank, *rest) for rank, (kind, *rest) in enumerate(secret_scan.PATTERNS))
    allowed = " OR ".join(f"regexp_matches(s, '{p}')" for p in secret_scan.ALLOWED)
    stretches = []
    for rank, kind in enumerate(secret_scan.CLASSES, len(secret_scan.PATTERNS)):
        matches = _matches_sql(kind.name, rank, kind.pattern, 0, kind.width)
        stretches.append(f"""
SELECT * FROM (
  SELECT doc, rank, kind, a, s, p, {kind.width} AS width, list_sum(list_transform(list_distinct(string_split(w, '')),
           lambda x: ({secret_scan.weights(kind.width)})[1 + length(w) - length(replace(w, x, '')) ])) AS weight
  FROM (SELECT *, substr(s, cast(p + 1 AS bigint), {kind.width}) AS w FROM (
    SELECT *, unnest(range(0, length(s) - {kind.width} + 1)) AS p FROM ({matches}) WHERE NOT ({allowed}))))
WHERE weight <= {kind.most_sum}""")
    windows = " UNION ALL ".join(stretches)
    return f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS t FROM documents),
known AS ({known}),
even AS ({windows}),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY doc, rank, a ORDER BY p) AS island FROM (
  SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc, rank, a ORDER BY p) + width THEN 0 ELSE 1 END AS fresh FROM even)),
added AS (SELECT doc, rank, kind, a + min(p) AS a, a + max(p) + any_value(width) AS b FROM islands
          GROUP BY doc, rank, kind, islands.a, island),
k AS (SELECT doc, count(*) FILTER (WHERE rank = 0) AS n0, count(*) FILTER (WHERE rank = 1) AS n1,
             count(*) FILTER (WHERE rank = 2) AS n2,
             string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans FROM known GROUP BY doc),
e AS (SELECT doc, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank, b) AS spans
      FROM (SELECT doc, rank, kind, a, b FROM known UNION ALL SELECT doc, rank, kind, a, b FROM added) GROUP BY doc)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(k.spans, '')) AS base_sha256, coalesce(e.spans, '') AS spans
FROM d LEFT JOIN k USING (doc) LEFT JOIN e USING (doc)"""


# crc32 of the decimal digits: each byte is mixed in and then eight bits are shifted out.
_CRC32 = """xor(list_reduce(
  flatten(list_transform(string_split(cast(t.c AS varchar), ''), lambda x: [cast(ascii(x) AS bigint)] || list_resize([-1::bigint], 8, -1))),
  lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r // 2, (r % 2) * 3988292384) END, 4294967295::bigint), 4294967295)"""
_TRIE = f"""
WITH RECURSIVE t AS (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT t.c, t.own, b.own AS base, {_CRC32} % 6 AS h FROM t LEFT JOIN t b ON b.c = t.c - t.c % 100),
full_paths AS (SELECT c, CASE WHEN base IS NULL THEN [] ELSE base[1:h] END || own[h + 1:] AS p FROM h),
m AS (SELECT c, d, p[1:d] AS k, len(p) AS n FROM (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM full_paths)),
nodes AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(cast(c AS varchar), ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends FROM m GROUP BY k, d),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children,
                      CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(nodes.k[d].t) END AS saved
               FROM nodes LEFT JOIN kids ON kids.k = nodes.k),
below AS (SELECT k[1:a] AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, cast(sum(saved) AS bigint) AS saved_tokens
          FROM (SELECT k, n_children, saved, unnest(range(0, d + 1)) AS a FROM full_nodes) GROUP BY 1)
SELECT x.conv_id, x.d AS depth, u.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens,
       sha256(x.ends) AS ends_sha256
FROM full_nodes x JOIN below ON below.k = x.k LEFT JOIN full_nodes u ON x.d > 0 AND u.k = x.k[1:x.d - 1]"""


def oracle_sql() -> dict[str, str]:
    """The other operators hash, draw, tokenize or train, which SQL cannot express; tests hold them to brute force."""
    return {
        "op4_minhash_near_dedup": _NEAR_DEDUP,
        "op6_substring_dedup": _SUBSTRINGS,
        "op8_revisit_resolution": _REVISITS,
        "op9_exact_top_k": _TOP_K,
        "op11_secret_scan": _secrets_sql(),
        "op13_conversation_prefix_trie": _TRIE,
    }
