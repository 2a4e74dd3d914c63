"""The queries of this subpackage, as (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.llm import decontaminate, exact_dedup, hard_negatives, html_extract, langid, mixing, periodic, quality_rules, sharding, simhash, token_count, url_filter, warc
from grafloom.llm.common import load, scratch_path, words

N_SHARDS = 40
#: Wanted shares of tokens by domain, see mixing.label_domains.
TARGET_WEIGHTS = {"clean": 0.96, "low": 0.02, "toxic": 0.02}


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(load(spark, sf_dir, "pages"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(load(spark, sf_dir, "pages"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(load(spark, sf_dir, "documents"), N_SHARDS, keep=["doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, load(spark, sf_dir, "labels")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"), mixing.label_domains(load(spark, sf_dir, "labels")), TARGET_WEIGHTS)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load(spark, sf_dir, "pages")).drop("payload", "url")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    model = langid.train(docs.where("not held_out"))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(load(spark, sf_dir, "documents"), token_count.tokenizer_path(), scratch_path(spark, "token-cache"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group(load(spark, sf_dir, "documents"))


def _repeating(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document by crc32 of the id, the words from number a on repeat p of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words(F.col("text"))).alias("w"))
    docs = docs.withColumn("n", F.coalesce(F.size("w"), F.lit(0)))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    left = F.col("n") - F.col("a")
    again = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), again), " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(_repeating(load(spark, sf_dir, "documents")))
    best = F.aggregate("runs", F.get("runs", 0), lambda a, x: F.when(x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.withColumns({"best": best, "lines": lines})
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(load(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_sharding": op4_sharding,
    "op5_decontamination": op5_decontamination,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_warc": op8_warc,
    "op9_language_id": op9_language_id,
    "op10_token_counts": op10_token_counts,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}

_URL = """SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)"""

#: Where SQL can express an operator's whole result. Learned models (op3, op6, op7, op9), XXH64 (op2) and tokenizers (op10) have none.
ORACLE_SQL: dict[str, str] = {
    "op1_url_filters": f"""
        WITH u AS ({_URL}), r(h, p, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block'))
        SELECT page_id, host, path, h || p AS rule, coalesce(v, CASE WHEN regexp_matches(host || path, '/(ads|adserver|banners|login|wp-admin)/') THEN 'block' ELSE 'allow' END) AS verdict
        FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) = 1""",
    "op4_sharding": """
        WITH t(tab) AS (SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) FROM range(256) x(n)),
        d AS (SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) + 16 AS size FROM documents),
        c AS (SELECT d.doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc FROM d, t),
        s AS (SELECT doc_id, size, crc, sum(size) OVER () AS whole, sum(size) OVER (ORDER BY doc_id, crc, size ROWS UNBOUNDED PRECEDING) - size AS before FROM c),
        p AS (SELECT *, least(39, ((before * 2 + size) * 40 // (whole * 2)))::INTEGER AS shard FROM s)
        SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY before) - 1 AS slot, NULL::INTEGER AS grown_shard FROM p""",
    "op5_decontamination": r"""
        WITH i AS (SELECT DISTINCT item_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
        iw AS (SELECT item_id, text, least(5, len(w)) AS k, list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda j: array_to_string(w[j : j + least(5, len(w)) - 1], ' '))) AS want FROM i WHERE len(w) > 0),
        x AS (SELECT item_id, text, k, len(want) AS n_item, unnest(want) AS shingle FROM iw),
        d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
        y AS (SELECT DISTINCT r, doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j : j + k - 1], ' '))) AS shingle FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)
        SELECT doc_id, item_id, count(*) AS n_shared, n_item, round(count(*) / n_item, 6) AS containment FROM x JOIN y USING (k, shingle) GROUP BY r, doc_id, item_id, x.text, n_item HAVING count(*) >= 0.8 * n_item - 1e-9""",
    "op8_warc": """
        WITH h AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best FROM pages)
        SELECT page_id, n::BIGINT AS payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, (i // 4 * 5 + 1)::INTEGER, 5))::BIGINT >> (15 - i % 4 * 5)) & 31) + 1)::INTEGER, 1)), '') AS payload_digest,
            CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to FROM h""",
    "op11_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents) WINDOW w AS (PARTITION BY t)""",
    "op12_periodic_runs": r"""
        WITH t(tab) AS (SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) FROM range(256) x(n)),
        c AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM documents, t),
        k AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g FROM c),
        a AS (SELECT *, CASE WHEN planted THEN g % n ELSE n END AS a FROM k), p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
        x AS (SELECT doc_id, n, i, w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1] AS word FROM p, LATERAL (SELECT unnest(range(n)) AS i)),
        e AS (SELECT u.doc_id, v.i - u.i AS q, u.i FROM x u JOIN x v ON u.doc_id = v.doc_id AND u.word = v.word AND v.i > u.i AND 3 * (v.i - u.i) <= u.n),
        s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e) GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
        r AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.doc_id = s.doc_id AND o.q < s.q AND s.q % o.q = 0 AND o.start <= s.start AND o.start + o.length >= s.start + s.length)),
        b AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM r GROUP BY doc_id),
        m AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / q DESC, start, q) = 1),
        y AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM x WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = x.doc_id AND x.i >= r.start + r.q AND x.i < r.start + r.length) GROUP BY doc_id)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, m.q AS period, 1000 * length // m.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
        FROM k LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN y USING (doc_id)""",
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i]))::BIGINT AS score FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10""",
}
