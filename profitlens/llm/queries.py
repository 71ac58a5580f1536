"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profitlens.llm import covertree, decontamination, divergence, language, licenses, packing, secrets, sharding, simhash, topk, toxicity, urlfilter, warc

SHARD_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def key_remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo the divisor; null without key."""
    return F.crc32(F.col(key).cast("string")) % divisor


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.FactorModel:
    """Learnt from the labelled documents that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    labelled = docs.select("doc_id", "text").join(labels.select("doc_id", "toxic"), "doc_id")
    return toxicity.fit(labelled.filter(key_remainder("doc_id", 5) != 0), "doc_id", "text", "toxic")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, folder), column="score", keep=["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(key_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.archive_and_index(table(spark, folder, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"), SHARD_BYTES)


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.find_licenses(docs, keep=["doc_id"])


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, folder, "benchmark"), keep=["doc_id"])
    hits = decontamination.hit_words("removal_spans")
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("matched_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("matched_items", ","), 256).alias("items_sha256"),
        decontamination.is_contaminated(hits, F.col("n_words")).alias("contaminated"),
    )


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    profiles = language.learn(docs.filter(key_remainder("doc_id", 3) != 1), "doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), profiles, keep=["doc_id"])
    held_out = F.coalesce(key_remainder("doc_id", 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, keep=["doc_id"])

    def spans_of(*kinds: str) -> Column:
        return F.filter("secret_spans", lambda span: span["kind"].isin(*kinds))

    base = spans_of(*secrets.BASE_KINDS)
    counts = [F.size(spans_of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.BASE_KINDS]
    return found.withColumn("base", base).select(
        "doc_id",
        *counts,
        F.sha2(secrets.spans_text("base"), 256).alias("base_sha256"),
        secrets.spans_text("secret_spans").alias("spans"),
    )


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), "vec_id % 50 = 0")


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


URL_RULES = "('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')"


def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {URL_RULES} AS rules(host, path, verdict)")
    return urlfilter.judge(table(spark, folder, "pages"), rules)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return covertree.mine(table(spark, folder, "embeddings").withColumn("label", moved), "vec_id % 100 = 0")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_warc": op3_warc,
    "op4_sharding": op4_sharding,
    "op5_licenses": op5_licenses,
    "op6_decontamination": op6_decontamination,
    "op7_language": op7_language,
    "op8_secrets": op8_secrets,
    "op9_simhash": op9_simhash,
    "op10_topk": op10_topk,
    "op11_source_divergence": op11_source_divergence,
    "op12_url_filter": op12_url_filter,
    "op13_hard_negatives": op13_hard_negatives,
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op3_warc": """
        WITH sized AS (
            SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        largest AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first_id
            FROM sized)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id < first_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id < first_id THEN first_id END AS refers_to
        FROM largest
    """,
    # the bucket of a row is the shallowest prefix of its hash that fits, or that holds one hash only
    "op4_sharding": f"""
        WITH hashed AS (
            SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
                CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
            FROM documents),
        levels AS (SELECT h, n_bytes, unnest(range(0, 61)) AS depth FROM hashed),
        buckets AS (
            SELECT depth, h >> (60 - depth) AS bucket FROM levels GROUP BY ALL
            HAVING sum(n_bytes) <= {SHARD_BYTES} OR min(h) = max(h)),
        placed AS (
            SELECT hashed.doc_id, hashed.n_bytes, hashed.h, min(buckets.depth) AS depth
            FROM hashed JOIN buckets ON (hashed.h >> (60 - buckets.depth)) = buckets.bucket
            GROUP BY ALL)
        SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth,
            CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> (60 - depth)), CAST(depth AS INTEGER), '0') END AS shard,
            CAST(0 AS BIGINT) AS part
        FROM placed
    """,
    "op6_decontamination": f"""
        WITH split AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
        items AS (SELECT item_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM benchmark),
        item_windows AS (
            SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS p
            FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM items WHERE len(w) > 0)),
        lengths AS (SELECT DISTINCT n FROM item_windows),
        doc_windows AS (
            SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS p
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM split, lengths WHERE len(w) >= n)),
        found AS (SELECT doc_id, item_id, n, i FROM doc_windows JOIN item_windows USING (n, p)),
        hit AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
        matched AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM found GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM split LEFT JOIN hit USING (doc_id) LEFT JOIN matched USING (doc_id)
    """,
    "op10_topk": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_source_divergence": f"""
        WITH rows AS (
            SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all({LOWER}, '{TERM}') AS w
            FROM documents),
        places AS (SELECT n, lang, source, unnest(w) AS term FROM rows),
        kept AS (SELECT lang, term, count(*) AS c FROM places GROUP BY ALL HAVING count(DISTINCT n) >= 30),
        langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY ALL),
        groups AS (SELECT DISTINCT lang, source FROM rows),
        used AS (SELECT lang, source, term, count(*) AS c FROM places SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        totals AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM groups LEFT JOIN used USING (lang, source) GROUP BY ALL),
        dense AS (
            SELECT lang, totals.source, term, coalesce(used.c, 0) AS c, langs.v,
                1 + (1000000000::HUGEINT * (coalesce(used.c, 0) + 5)) // (totals.n + 5 * langs.v)::HUGEINT AS p,
                1 + (1000000000::HUGEINT * (kept.c + 5)) // (langs.n + 5 * langs.v)::HUGEINT AS q
            FROM totals JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN used USING (lang, source, term)),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
            UNION ALL SELECT lang, source, 'term', term, p - q FROM dense WHERE c > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
            CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM parts QUALIFY part = 'pair' OR rank <= 50
    """,
    "op12_url_filter": f"""
        WITH rules(h, p, v) AS (VALUES {URL_RULES}),
        cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        split AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
            FROM cut),
        keyed AS (SELECT coalesce(host, '') AS host, coalesce(path, '') AS path, page_id, row_number() OVER () AS n FROM split),
        fitting AS (
            SELECT n, h || p AS rule, v FROM keyed JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
            QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(h || p) DESC, length(h) DESC) = 1)
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM keyed LEFT JOIN fitting USING (n)
    """,
    "op13_hard_negatives": """
        WITH whole AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS other_id, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
            FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(c.v) = len(a.v)),
        positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
        ranked AS (
            SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
                CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
            FROM positives JOIN scored USING (anchor_id)
            WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT * FROM ranked WHERE rank <= 10
    """,
}
