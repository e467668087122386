"""The registered queries of this package, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.llm import (
    alignment,
    decontamination,
    exact_dedup,
    hard_negatives,
    huffman,
    mixing,
    packing,
    pii,
    resharding,
    shingle_join,
    topk,
    toxicity,
    url_rules,
)
from corpuslink.session import shared_folder, small_batches


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.similar_documents(_documents(spark, sf_dir))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's counts are those of the fixed base spans; the method's own are ``n_added``."""
    found = pii.personal_data(_documents(spark, sf_dir))
    counts = [F.col(f"n_base_{k}").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, "base_sha256", "spans", "n_added")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxic_documents(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir), keep="largest")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("id"), "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(pages, rules).withColumnRenamed("id", "page_id")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    huffman.write_ids(_documents(spark, sf_dir), folder)
    return huffman.read_ids(spark, folder)


def op9_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve shards written as files, changed to sixteen; all columns come from the files."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    layout = resharding.Layout(spark, shared_folder(spark, "shards"))
    layout.write(docs, 12)
    layout.reshard(docs.schema, 16)
    text = F.coalesce("text", F.lit(""))
    rows = layout.read(docs.schema).select(
        "row_key", "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
    )
    return rows.join(layout.slots().drop("shard"), "row_key").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.rates(_documents(spark, sf_dir), MIX_TARGETS, MIX_KEEP)
    return mixed.withColumn("probability", F.round("probability", 6))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(_documents(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = hard_negatives.labelled_vectors(rows, "vec_id", "embedding", label, scale=256)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


#: Sources and topics a little flatter than they are, languages as named, a twentieth for all others;
#: half of all words.
MIX_TARGETS = {"source": 0.7, "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15, "*": 0.05}, "topic": 0.8}
MIX_KEEP = 0.5

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]



def _mixing_sql() -> str:
    """The same rounds as nested tables: shares, raking, calibration, draw."""
    shares = {}
    for dim, target in MIX_TARGETS.items():
        if isinstance(target, dict):
            named = {k: v for k, v in target.items() if k != "*"}
            cases = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in named.items())
            others = f"sum(CASE WHEN {dim} IN {tuple(named)} THEN 0.0 ELSE s END) OVER ()"
            rest = f"CAST({target.get('*', 0.0)!r} AS DOUBLE) * s / {others}"
            shares[dim] = f"CASE WHEN s > 0 THEN CASE {dim} {cases} ELSE {rest} END ELSE 0.0 END"
        else:
            shares[dim] = f"CASE WHEN s > 0 THEN pow(s, {target!r}) ELSE 0.0 END"
    tables = [
        """seen AS (
            SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang,
                   CASE WHEN contains(t, ' | ') THEN 'table' WHEN regexp_matches(t, '[#$%&*]{3}') THEN 'marked'
                        WHEN length(t) >= 4000 THEN 'long' ELSE 'prose' END AS topic,
                   len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS n_words
            FROM (SELECT *, coalesce(text, '') AS t FROM documents)
        )""",
        """cells AS (SELECT source, lang, topic, CAST(sum(n_words) AS DOUBLE) AS tokens FROM seen GROUP BY ALL)""",
        *(
            f"""{dim}_share AS MATERIALIZED (
            SELECT {dim}, share / sum(share) OVER () AS share FROM (
                SELECT {dim}, {rule} AS share FROM (SELECT {dim}, sum(tokens) AS s FROM cells GROUP BY {dim})))"""
            for dim, rule in shares.items()
        ),
        "w0 AS (SELECT *, tokens AS weight FROM cells)",
    ]
    step = 0
    for _ in range(mixing.ROUNDS):
        for dim in MIX_TARGETS:
            tables.append(
                f"""w{step + 1} AS MATERIALIZED (
            SELECT source, lang, topic, tokens, CASE WHEN s > 0 THEN weight * share / s ELSE 0.0 END AS weight
            FROM (SELECT *, sum(weight) OVER (PARTITION BY {dim}) AS s FROM w{step}) JOIN {dim}_share USING ({dim}))"""
            )
            step += 1
    tables.append(f"f0 AS (SELECT {MIX_KEEP} * sum(tokens) AS budget, {MIX_KEEP} * sum(tokens) AS factor FROM cells)")
    for k in range(mixing.CALIBRATIONS):
        tables.append(
            f"""f{k + 1} AS MATERIALIZED (
            SELECT any_value(budget) AS budget,
                   CASE WHEN sum(CASE WHEN weight * factor >= tokens THEN 0.0 ELSE weight END) > 0
                        THEN greatest(0.0, any_value(budget) - sum(CASE WHEN weight * factor >= tokens THEN tokens ELSE 0 END))
                             / sum(CASE WHEN weight * factor >= tokens THEN 0.0 ELSE weight END)
                        ELSE any_value(factor) END AS factor
            FROM w{step}, f{k})"""
        )
    return f"""
        WITH {", ".join(tables)},
        p AS (
            SELECT source, lang, topic,
                   CASE WHEN tokens > 0 THEN least(1.0, factor * weight / tokens) ELSE {MIX_KEEP} END AS p
            FROM w{step}, f{mixing.CALIBRATIONS}
        )
        SELECT doc_id, source, lang, topic, CAST(n_words AS BIGINT) AS n_words, round(p, 6) AS probability,
               CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
                   / CAST(4503599627370496 AS DOUBLE) < p AS kept
        FROM seen JOIN p USING (source, lang, topic)
    """


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shingle_join": op1_shingle_join,
    "op2_top_k": op2_top_k,
    "op3_pii": op3_pii,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_url_rules": op7_url_rules,
    "op8_token_files": op8_token_files,
    "op9_resharding": op9_resharding,
    "op10_mixing": op10_mixing,
    "op11_decontamination": op11_decontamination,
    "op12_alignment": op12_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL: dict[str, str] = {
    "op1_shingle_join": """
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents
        ),
        sets AS MATERIALIZED (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
            FROM worded
        ),
        sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
        ),
        links AS MATERIALIZED (
            SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
            WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)
        ),
        both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached(id, other) AS (
            SELECT DISTINCT a, a FROM both_ways UNION
            SELECT r.id, w.b FROM reached r JOIN both_ways w ON w.a = r.other
        ),
        least AS (SELECT id, min(other) AS component FROM reached GROUP BY id)
        SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id
        FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN least l ON l.id = d.doc_id
    """,
    "op2_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        )
        SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
        WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER best <= 10
    """,
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op7_url_rules": """
        WITH rest AS (
            SELECT page_id,
                   CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
            FROM pages
        ),
        parts AS (
            SELECT page_id,
                   translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(r, '(?s)^[^/?#]*([^?#]*)', 1) AS path
            FROM rest
        ),
        rules(rule_host, rule_path, rule_verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                   ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        )
        SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
        FROM parts LEFT JOIN rules
          ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) = 1
    """,
    "op10_mixing": _mixing_sql(),
    "op11_decontamination": """
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents
        ),
        items AS (
            SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark
        ),
        windows AS MATERIALIZED (
            SELECT DISTINCT item, least(10, len(words)) AS n, unnest(list_transform(
                range(1, greatest(len(words) - 9, 1) + 1), lambda i: array_to_string(words[i:i + 9], ' '))) AS w
            FROM items WHERE len(words) > 0
        ),
        lengths AS (SELECT DISTINCT n FROM windows),
        places AS (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS p FROM docs, lengths WHERE len(words) >= n),
        runs AS (SELECT r, n, p, array_to_string(words[p:p + n - 1], ' ') AS w FROM places),
        hits AS MATERIALIZED (SELECT r, p, runs.n AS n, item FROM runs JOIN windows ON runs.n = windows.n AND runs.w = windows.w),
        hit_words AS (
            SELECT r, count(DISTINCT i) AS n_hit
            FROM (SELECT r, unnest(range(p, p + n)) AS i FROM (SELECT DISTINCT r, p, n FROM hits)) GROUP BY r
        ),
        hit_items AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
        ),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER best AS INTEGER) AS rank,
               n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
        WINDOW best AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
        QUALIFY row_number() OVER best <= 5
    """,
}
