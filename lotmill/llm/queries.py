"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill.llm import decontaminate, langid, lexical, licenses, lm, maintext, minhash, negatives, packing, sharding, topk, toxicity, urls
from lotmill.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op4_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved))


def op13_maintext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_backoff": op3_backoff,
    "op4_hyperminhash": op4_hyperminhash,
    "op5_licenses": op5_licenses,
    "op6_topk": op6_topk,
    "op7_decontaminate": op7_decontaminate,
    "op8_urls": op8_urls,
    "op9_langid": op9_langid,
    "op10_shards": op10_shards,
    "op11_lexical": op11_lexical,
    "op12_negatives": op12_negatives,
    "op13_maintext": op13_maintext,
}

ORACLE = {
    "op3_backoff": r"""
        WITH b AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
        ids AS (
            SELECT doc_id, xor(list_reduce(range(8 * len(s)), lambda c, i: xor(
                xor(c, CASE WHEN i % 8 = 0 THEN CAST(ascii(s[i // 8 + 1]) AS BIGINT) ELSE 0 END) >> 1,
                CASE WHEN xor(c, CASE WHEN i % 8 = 0 THEN CAST(ascii(s[i // 8 + 1]) AS BIGINT) ELSE 0 END) % 2 = 1
                    THEN 3988292384 ELSE 0 END), 4294967295), 4294967295) AS crc32_text FROM b),
        t AS MATERIALIZED (
            SELECT doc_id, row_number() OVER () AS r, coalesce(crc32_text % 7 = 2, false) AS held_out, list_append(list_filter(
                regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> ''), chr(10)) AS ws
            FROM documents LEFT JOIN ids USING (doc_id)),
        x AS MATERIALIZED (
            SELECT r, held_out, unnest(list_zip(list_prepend(chr(9), ws[:-2]), ws)) AS p FROM t),
        y AS MATERIALIZED (SELECT r, held_out, p[1] AS v, p[2] AS w FROM x),
        c1 AS MATERIALIZED (SELECT w, count(*) AS c FROM y WHERE NOT held_out GROUP BY 1),
        c2 AS MATERIALIZED (SELECT v, w, count(*) AS c FROM y WHERE NOT held_out GROUP BY 1, 2),
        h AS (SELECT w, c FROM c1 UNION ALL SELECT chr(9), count(*) FROM t WHERE NOT held_out),
        k AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n, count(*) AS d FROM c1)
        SELECT any_value(t0.doc_id) AS doc_id, any_value(y.held_out) AS held_out, count(*) AS n_tokens,
            count(*) FILTER (c1.c > 0) AS n_known, any_value(k.n) AS train_tokens,
            round(sum(log10((coalesce(c1.c, 0) + 1) / (k.n + k.d + 1))), 6) AS base_score,
            round(sum(log10((coalesce(c2.c, 0) + 8.0::DOUBLE * (coalesce(c1.c, 0) + 1) / (k.n + k.d + 1))
                / (coalesce(h.c, 0) + 8.0::DOUBLE))), 6) AS score
        FROM y JOIN t t0 ON t0.r = y.r CROSS JOIN k LEFT JOIN c1 ON c1.w = y.w
        LEFT JOIN c2 ON c2.v = y.v AND c2.w = y.w LEFT JOIN h ON h.w = y.v
        GROUP BY y.r
    """,
    "op4_hyperminhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS MATERIALIZED (
            SELECT doc_id, CASE WHEN ws IS NULL OR len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [hash(ws)]
                ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: hash(ws[i:i + 4]))) END AS sh FROM w),
        n AS MATERIALIZED (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
        x AS MATERIALIZED (SELECT doc_id, unnest(sh) AS g FROM s),
        link AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b, any_value(m.n) + any_value(k.n) AS total, count(*) AS c
            FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
            JOIN n m ON m.doc_id = a.doc_id JOIN n k ON k.doc_id = b.doc_id
            GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(m.n) + any_value(k.n) - count(*))),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other),
        c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
        SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
    """,
    "op5_licenses": licenses.duck_sql(),
    "op6_topk": """
        WITH e AS (
            SELECT vec_id, embedding FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS (
            SELECT vec_id, generate_subscripts(embedding, 1) AS dim,
                   CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
            FROM e),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON q.dim = c.dim AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0 GROUP BY ALL)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 20
    """,
    "op7_decontaminate": r"""
        WITH t AS (
            SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id, text FROM documents
            UNION ALL SELECT 'i', row_number() OVER (), item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        w AS (
            SELECT kind, r, id, list_filter(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM t),
        s AS (
            SELECT kind, r, id, CASE WHEN ws IS NULL OR len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [hash(ws)]
                ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: hash(ws[i:i + 4]))) END AS sh FROM w),
        d AS MATERIALIZED (SELECT r, id, unnest(sh) AS g FROM s WHERE kind = 'd'),
        i AS MATERIALIZED (SELECT r, id, CAST(len(sh) AS BIGINT) AS n, unnest(sh) AS g FROM s WHERE kind = 'i')
        SELECT any_value(d.id) AS doc_id, any_value(i.id) AS item_id, any_value(n) AS item_shingles, count(*) AS shared
        FROM d JOIN i ON d.g = i.g GROUP BY d.r, i.r HAVING 100 * count(*) >= 75 * any_value(n)
    """,
    "op8_urls": """
        WITH rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
            ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        rest AS (
            SELECT page_id, row_number() OVER () AS n, CASE WHEN contains(url, '://')
                THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
        parts AS (
            SELECT page_id, n, regexp_extract(r, '^[^/?#]*') AS h0,
                   regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest),
        urls AS (
            SELECT page_id, n, path, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts)
        SELECT page_id, host, path, h || p AS rule, coalesce(v, 'allow') AS verdict
        FROM urls LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC) = 1
    """,
    "op11_lexical": r"""
        WITH d AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
        i AS (
            SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
        q AS MATERIALIZED (
            SELECT i, item_id, t, count(*) AS qn FROM (SELECT i, item_id, unnest(ts) AS t FROM i) GROUP BY ALL),
        k AS (SELECT count(*) FILTER (len(ts) > 0) AS n, CAST(sum(len(ts)) AS BIGINT) AS l FROM d),
        f AS MATERIALIZED (
            SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d)
            WHERE t IN (SELECT t FROM q) GROUP BY ALL),
        w AS (
            SELECT t, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM f CROSS JOIN k GROUP BY t, n),
        m AS (SELECT r, doc_id, 75 + (25 * len(ts) * n) // l AS m FROM d CROSS JOIN k WHERE len(ts) > 0),
        s AS (
            SELECT i, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id,
                CAST(sum(qn * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
            FROM q JOIN f USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY i, r)
        SELECT item_id, CAST(row_number() OVER o AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
        WINDOW o AS (PARTITION BY i ORDER BY score DESC, doc_id)
        QUALIFY row_number() OVER o <= 20
    """,
    "op12_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS (
            SELECT vec_id, label, generate_subscripts(embedding, 1) AS dim,
                   CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM e),
        s AS MATERIALIZED (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
            FROM v a JOIN v c ON a.dim = c.dim AND a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0 GROUP BY ALL),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER o AS INTEGER) AS rank, vec_id AS negative_id,
            positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER o <= 5
    """,
}
