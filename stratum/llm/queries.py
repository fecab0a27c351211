"""The registered queries of this subpackage: each applies one operator to its whole table. SQL where DuckDB can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import load

from . import bpe, convrepair, convtrie, embdup, mixing, packing, quality, simhash, suffix, tokcount, toxicity, urlfilter, warc

#: (verdict, host, path)
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokcount.token_counts(load(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"), size=3, distance=2)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), window=2048, end_id=1)


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(load(spark, sf_dir, "documents"), length=200)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdup.near_duplicates(load(spark, sf_dir, "embeddings"), cosine=0.98)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(load(spark, sf_dir, "pages"), list(URL_RULES))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(load(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(load(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(load(spark, sf_dir, "documents"), weights=(5, 2, 1), max_epochs=3)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.prefix_trie(convtrie.rebuilt(convtrie.sequences(load(spark, sf_dir, "conversations")), group=5, most=9))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations")
    return convrepair.repair(convrepair.damage(turns), ids=turns)


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_toxicity, op3_simhash, op4_packing, op5_suffix_array, op6_quality,
                                   op7_embedding_links, op8_url_filter, op9_warc, op10_bpe, op11_mixing, op12_prefix_trie, op13_conversation_repair)}

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in quality.CASED)


def _rules_sql(rules) -> str:
    parts = []
    for metric, low, high, least in rules:
        bounds = [f"{metric} >= {low}"] * (low is not None) + [f"{metric} <= {high}"] * (high is not None)
        parts.append(f"(({' AND '.join(bounds)}) OR n_words < {least})")
    return " AND ".join(parts)


def quality_sql(source: str, rules=quality.RULES) -> str:
    """The counts, base_failed and kept for a table or subquery with doc_id and text."""
    return f"""
WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {source}),
w AS (SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0b\\f\\r]')) AS ls FROM src),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             len(ls)::BIGINT AS n_lines, len(list_filter(ws, lambda x: x IN ({_STOP})))::BIGINT AS n_stop_words,
             len(regexp_extract_all(t, '\\p{{Lu}}{{2}}'))::BIGINT AS n_shout_pairs
      FROM w LEFT JOIN c USING (rid)),
q AS (SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(word_chars, 1) AS symbol_ratio,
             n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio, n_shout_pairs * 2 / greatest(word_chars, 1) AS shout_ratio,
             n_stop_words / greatest(n_words, 1) AS stop_word_ratio,
             (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND {_rules_sql(rules)}) AS kept FROM q"""


def url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return f"""
WITH r(verdict, h, p) AS (VALUES {rules}),
u AS (SELECT page_id, row_number() OVER () AS rid, CASE WHEN strpos(url, '://') > 0
        THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, rid, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM u),
f AS (SELECT s.rid, r.h || r.p AS rule, r.verdict,
             row_number() OVER (PARTITION BY s.rid ORDER BY length(r.h || r.p) DESC, r.verdict DESC) AS k
      FROM s JOIN r ON (s.host = r.h OR ends_with(s.host, '.' || r.h)) AND starts_with(s.path, r.p))
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM s LEFT JOIN f ON s.rid = f.rid AND f.k = 1"""


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS payload_digest,
                  strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
t AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS target FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN target IS NOT NULL AND page_id IS DISTINCT FROM target THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN target IS NOT NULL AND page_id IS DISTINCT FROM target THEN target END AS refers_to FROM t"""

EMBEDDING_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
       WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
good AS (SELECT * FROM ok WHERE n > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
         WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
k AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(k.n, 0)::BIGINT AS n_links, c.component_id, vec_id = c.component_id AS kept
FROM embeddings LEFT JOIN k ON k.a = vec_id LEFT JOIN c ON c.a = vec_id"""


def crc32_sql(text: str) -> str:
    """The CRC-32 of an ASCII string: each byte is mixed in, then eight shifts with the polynomial."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [unicode(substr({text}, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    one = "(xor(c, x) >> 1)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, x: CASE WHEN xor(c, x) & 1 = 1 THEN "
            f"xor({one}, 3988292384) ELSE {one} END), 4294967295)")


#: Turns of equal number are ordered by the digest of role and text, as the operators do.
_DIGEST = "md5(length(role) || ':' || role || text)"

TRIE_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, {_DIGEST} AS w, strlen(text)::BIGINT AS b, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_DIGEST}) AS p FROM t),
c AS (SELECT DISTINCT conv_id, {crc32_sql("conv_id::VARCHAR")} % 9 AS h FROM t),
r AS (SELECT c.conv_id, 0 AS tail, p, w, b FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 5 AND p <= h
      UNION ALL SELECT conv_id, 1, p, w, b FROM c JOIN o USING (conv_id) WHERE p > h),
s AS (SELECT conv_id, coalesce(list(w ORDER BY tail, p) FILTER (WHERE p IS NOT NULL), []) AS w,
             coalesce(list(b ORDER BY tail, p) FILTER (WHERE p IS NOT NULL), []) AS b FROM c LEFT JOIN r USING (conv_id) GROUP BY conv_id),
e AS (SELECT conv_id, w, b, unnest(range(0, len(w) + 1)) AS depth FROM s),
n AS (SELECT list_slice(w, 1, depth) AS k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(coalesce(b[depth], 0)) AS b,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(w) = depth), '') AS ends FROM e GROUP BY 1, 2),
up AS (SELECT *, list_slice(k, 1, depth - 1) AS pk FROM n WHERE depth > 0),
kids AS (SELECT pk AS k, count(*) AS n_children FROM up GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * b AS saved FROM n LEFT JOIN kids USING (k)),
sub AS (SELECT list_slice(k, 1, d) AS k, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved
        FROM (SELECT k, n_children, saved, unnest(range(0, depth + 1)) AS d FROM f) GROUP BY 1)
SELECT f.conv_id::BIGINT AS conv_id, f.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
       f.n_children::BIGINT AS n_children, sub.n_leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN sub USING (k) LEFT JOIN n p ON f.depth > 0 AND p.k = list_slice(f.k, 1, f.depth - 1)"""


def _repair_sql() -> str:
    """Backward costs row by row, a value for each place of the pattern: nine digits of cost, the audit, ``!``, the repaired rows."""
    def add(v: str, cost: str, letter: str, row: str = "''") -> str:
        audit, rows = f"split_part(substr({v}, 10), '!', 1)", f"substr({v}, 11 + length(split_part(substr({v}, 10), '!', 1)))"
        return f"lpad((substr({v}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{letter}' || {audit} || '!' || {row} || {rows}"

    last, rows = "chr(10)", []
    for x in range(4):
        to = convrepair.STEP[x]
        role = "assistant" if to == convrepair.AFTER_A else "user"
        ways = [add(f"v{x}", "4", "D"),
                f"CASE WHEN fault IN (0, 3) THEN {add(f'v{to}', '3 + fault', 'R', f"'{role}:' || text || {last}")} END"]
        ways += [f"CASE WHEN fault IN (0, 3) AND initial = '{initial}' THEN {add(f'v{at}', 'fault', 'K', f"role || ':' || text || {last}")} END"
                 for initial, at in zip("sua", convrepair.KEEP[x]) if at >= 0]
        rows.append(f"least({', '.join(ways)}) AS r{x}")
    inserted = []
    for x in range(4):
        one, two = convrepair.STEP[x], convrepair.STEP[convrepair.STEP[x]]
        word = lambda to: "'assistant:' || chr(10)" if to == convrepair.AFTER_A else "'user:' || chr(10)"
        twice = add(f"r{two}", "3", "I", word(two))
        inserted.append(f"least(r{x}, {add(f'r{one}', '3', 'I', word(one))}, {add(f'({twice})', '3', 'I', word(one))}) AS v{x}")
    end = ["'000000000!'", "'000000006II!user:' || chr(10) || 'assistant:' || chr(10)", "'000000003I!assistant:' || chr(10)", "'000000000!'"]
    kind = crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))") + " % 20"
    return f"""
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {kind} AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM t WHERE kind <> 0),
g AS (SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_DIGEST}, copy) AS i FROM d),
q AS (SELECT *, CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                     WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM g),
s AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
             count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
             count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM q GROUP BY conv_id),
v AS (SELECT conv_id, n AS i, {', '.join(f'{e} AS v{x}' for x, e in enumerate(end))} FROM s
      UNION ALL
      SELECT conv_id, i - 1, {', '.join(inserted)} FROM (SELECT v.conv_id, v.i, {', '.join(rows)} FROM v JOIN q ON q.conv_id IS NOT DISTINCT FROM v.conv_id AND q.i = v.i)),
b AS (SELECT conv_id, substr(v0, 1, 9)::BIGINT AS cost, split_part(substr(v0, 10), '!', 1) AS audit,
             substr(v0, 11 + length(split_part(substr(v0, 10), '!', 1))) AS fixed FROM v WHERE i = 0)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(left(fixed, greatest(length(fixed) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id"""


ORACLE = {"op6_quality": quality_sql("documents"), "op7_embedding_links": EMBEDDING_SQL, "op8_url_filter": url_sql(), "op9_warc": WARC_SQL,
          "op12_prefix_trie": TRIE_SQL, "op13_conversation_repair": _repair_sql()}
