"""The operators on the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelens.llm import fim, jaccard, langid, line_dedup, mixing, packing, phrases, quality, secret_scan, token_counts, topk, urls, warc
from carelens.llm.common import table

QUERIES: dict = {}
CHECKS: dict = {}


def query(key: str, sql: str | None = None):
    def keep(fn):
        QUERIES[key] = fn
        if sql is not None:
            CHECKS[key] = sql
        return fn

    return keep


@query(
    "op1_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
    w AS (SELECT payload_digest, max(page_id) AS last FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id < last THEN last END AS refers_to
    FROM d LEFT JOIN w USING (payload_digest)
    """,
)
def op1_warc(spark, sf_dir):
    records = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op4_top_k",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vec, c.vec) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op4_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query(
    "op7_url_filter",
    r"""
    WITH p AS (
        SELECT page_id,
               translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
        FROM pages),
    j AS (
        SELECT *, CASE
            WHEN '.' || host LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN '.' || host LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN '.' || host LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
        FROM p)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM j
    """,
)
def op7_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules, "page_id", "url")


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query("op3_secret_scans")
def op3_secret_scans(spark, sf_dir):
    return secret_scan.scan_digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


@query(
    "secret_base_spans",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    k(kind, rank, expr) AS (VALUES
        ('assign', 1, '(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'),
        ('access', 2, 'AKIA[A-Z0-9]+'), ('hex', 3, '[0-9a-f]+')),
    m AS (
        SELECT doc_id, 'assign' AS kind, 1 AS rank, regexp_extract_all(text, (SELECT expr FROM k WHERE rank = 1)) AS hit, string_split_regex(text, (SELECT expr FROM k WHERE rank = 1)) AS rest FROM d
        UNION ALL SELECT doc_id, 'access', 2, regexp_extract_all(text, 'AKIA[A-Z0-9]+'), string_split_regex(text, 'AKIA[A-Z0-9]+') FROM d
        UNION ALL SELECT doc_id, 'hex', 3, regexp_extract_all(text, '[0-9a-f]{16,}'), string_split_regex(text, '[0-9a-f]{16,}') FROM d),
    p AS (SELECT doc_id, kind, rank, hit[i] AS hit,
                 list_sum(list_transform(rest[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hit[1:i - 1], lambda x: length(x))), 0) AS start
          FROM m, unnest(range(1, len(hit) + 1)) AS t(i)),
    v AS (SELECT *, start + length(hit) AS stop, CASE kind WHEN 'assign' THEN length(regexp_extract(hit, '[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) ELSE length(hit) END AS size FROM p),
    g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                 string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank) AS spans
          FROM v WHERE size >= CASE kind WHEN 'assign' THEN 12 WHEN 'access' THEN 18 ELSE 16 END GROUP BY 1)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256
    FROM d LEFT JOIN g ON d.doc_id = g.doc_id
    """,
)
def secret_base_spans(spark, sf_dir):
    """What SQL can say of the secret scan: spans of the base kinds."""
    return op3_secret_scans(spark, sf_dir).drop("spans")


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


MAX_REPEATS = 2.0


@query(
    "op6_source_mixing",
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
    s AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS n FROM d GROUP BY 1),
    m AS (SELECT CAST(max(n) AS DOUBLE) AS most, CAST(min(n) FILTER (n > 0) AS DOUBLE) AS least FROM s),
    b(step, low, high) AS (
        SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
        UNION ALL
        SELECT step + 1, CASE WHEN fits THEN low ELSE mid END, CASE WHEN fits THEN mid ELSE high END
        FROM (SELECT b.*, (low + high) / 2 AS mid, pow(least / most, (low + high) / 2 - 1) <= 2 AS fits FROM b, m WHERE step < 32)),
    a AS (SELECT CASE WHEN pow(least / most, -1) <= 2 THEN 0 ELSE high END AS a, most FROM b, m WHERE step = 32),
    p AS (SELECT source, n, CASE WHEN n > 0 THEN CAST(floor(n * pow(n / most, a - 1)) AS BIGINT) ELSE 0 END AS budget FROM s, a),
    w AS (SELECT source, CASE WHEN n > 0 THEN budget // n ELSE 1 END AS whole, CASE WHEN n > 0 THEN budget % n ELSE 0 END AS rest FROM p),
    k AS (
        SELECT d.*, whole, rest, sum(n_tokens) OVER (
                   PARTITION BY d.source ORDER BY md5('mix:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), ''))
                   RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
        FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source),
    t AS (SELECT *, unnest(range(whole + CASE WHEN rest > 0 AND running <= rest THEN 1 ELSE 0 END)) AS pass FROM k),
    o AS (SELECT *, md5('mix:' || pass || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM t)
    SELECT doc_id, source, n_tokens, CAST(pass AS INTEGER) AS pass,
           CAST(floor(CAST('0x' || left(place, 8) AS BIGINT) * floor(sqrt((SELECT count(*) FROM d))) / 4294967296) AS BIGINT) AS block, place
    FROM o
    """,
)
def op6_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), max_repeats=MAX_REPEATS)


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    return langid.train_and_identify(table(spark, sf_dir, "documents"))


@query(
    "op8_jaccard_join",
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS own FROM w),
    e AS (SELECT doc_id, len(own) AS n, unnest(own) AS shingle FROM s),
    shares AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n, b.n AS m, count(*) AS shared FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shares WHERE 100 * shared >= 80 * (n + m - shared)),
    ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (SELECT a AS doc_id, a AS other FROM ends UNION SELECT r.doc_id, ends.b FROM reached r JOIN ends ON r.other = ends.a)
    SELECT s.doc_id, CAST(len(own) AS BIGINT) AS n_shingles, coalesce(min(other), s.doc_id) AS component_id
    FROM s LEFT JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id, len(own)
    """,
)
def op8_jaccard_join(spark, sf_dir):
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


@query(
    "op11_fill_in_middle",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    u AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units FROM d),
    n AS (SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                 CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM u),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
    p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM c)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p
    """,
)
def op11_fill_in_middle(spark, sf_dir):
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256")
    )


@query(
    "op12_phrase_mining",
    r"""
    WITH t AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    p AS (SELECT row, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
    q AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    o AS (SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS pos FROM q),
    s AS (SELECT lang, w1, lead(w1) OVER z AS w2, lead(w1, 2) OVER z AS w3 FROM o WINDOW z AS (PARTITION BY piece ORDER BY pos)),
    n AS (SELECT lang, count(*) AS n FROM o GROUP BY 1),
    f AS (
        SELECT lang, w1, NULL AS w2, NULL AS w3, count(*) AS f FROM s GROUP BY 1, 2 HAVING count(*) >= 10
        UNION ALL SELECT lang, w1, w2, NULL, count(*) FROM s WHERE w2 IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 10
        UNION ALL SELECT lang, w1, w2, w3, count(*) FROM s WHERE w3 IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) >= 10),
    f1 AS (SELECT lang, w1, f FROM f WHERE w2 IS NULL),
    f2 AS (SELECT lang, w1, w2, f FROM f WHERE w2 IS NOT NULL AND w3 IS NULL),
    f3 AS (SELECT * FROM f WHERE w3 IS NOT NULL),
    m AS (SELECT lang, w1, w2, max(f) AS most FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY 1, 2, 3),
    k2 AS (SELECT f2.* FROM f2 LEFT JOIN m USING (lang, w1, w2) WHERE most IS NULL OR 100 * most < 50 * f2.f),
    x AS (
        SELECT k2.lang, k2.w1 || ' ' || k2.w2 AS phrase, k2.f AS a, 1 AS k, a1.f AS l, b1.f AS r
        FROM k2 JOIN f1 a1 ON a1.lang = k2.lang AND a1.w1 = k2.w1 JOIN f1 b1 ON b1.lang = k2.lang AND b1.w1 = k2.w2
        UNION ALL
        SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 1, a1.f, b2.f
        FROM f3 JOIN f1 a1 ON a1.lang = f3.lang AND a1.w1 = f3.w1 JOIN f2 b2 ON b2.lang = f3.lang AND b2.w1 = f3.w2 AND b2.w2 = f3.w3
        UNION ALL
        SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 2, a2.f, b1.f
        FROM f3 JOIN f2 a2 ON a2.lang = f3.lang AND a2.w1 = f3.w1 AND a2.w2 = f3.w2 JOIN f1 b1 ON b1.lang = f3.lang AND b1.w1 = f3.w3),
    y AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM x),
    z AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM y),
    v AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM z WHERE cut = 1)
    SELECT lang, rank, phrase, a, l, r, n, score FROM v JOIN n USING (lang) WHERE rank <= 2000
    """,
)
def op12_phrase_mining(spark, sf_dir):
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


@query(
    "op13_line_dedup",
    r"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    x AS (SELECT row, doc_id, string_split(text, chr(10)) AS lines FROM d),
    l AS (SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM x),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    h AS (SELECT key, count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) AS docs, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY 1),
    g AS (SELECT k.*, coalesce(h.docs >= 2 AND k.doc_id IS DISTINCT FROM h.keeper, false) AS gone FROM k LEFT JOIN h USING (key))
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM g GROUP BY row
    """,
)
def op13_line_dedup(spark, sf_dir):
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
