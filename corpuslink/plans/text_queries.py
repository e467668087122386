"""Registered character model queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators import textmodel
from corpuslink.plans import views
from corpuslink.session import cut_lineage, shared_folder
from corpuslink.sources import textfiles
from corpuslink.streaming import modelstore

ORDER = 2
LANGS = ("de", "en", "es", "fr")
ROLES = ("user", "assistant")


def _by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.texts(spark, sf_dir, "conversations", "role", "text").select(F.col("role").alias("label"), "text")


def _by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.texts(spark, sf_dir, "documents", "lang", "text").select(F.col("lang").alias("label"), "text")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn_id = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return views.texts(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(turn_id.alias("doc_id"), "text")


def char_gram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textmodel.gram_counts(_by_role(spark, sf_dir), ORDER)


def char_gram_counts_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grams of each conversation role with every text held in rows of 50 characters."""
    turns = views.table(spark, sf_dir, "conversations")
    cut = F.posexplode(F.regexp_extract_all("text", F.lit("(?s).{1,50}"), F.lit(0))).alias("part_no", "part")
    turn_id = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    parts = turns.select(F.col("role").alias("label"), turn_id.alias("text_id"), cut)
    return textmodel.gram_counts_of_parts(parts.withColumnRenamed("part", "text"), ORDER)


#: Conversations whose turns make up one file.
FILE_CONVERSATIONS = 500


def gram_counts_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of a role as lines of files, read back in parts and counted over each file as a ring."""
    folder = shared_folder(spark, "turn-files")
    turns = views.table(spark, sf_dir, "conversations").select(
        "role", F.floor(F.col("conv_id") / FILE_CONVERSATIONS).alias("file"), "conv_id", "turn", F.col("text").alias("value")
    )
    (
        turns.repartition("role", "file").sortWithinPartitions("role", "file", "conv_id", "turn")
        .select("role", "file", "value").write.partitionBy("role", "file").text(folder)
    )
    parts = textfiles.read_text_parts(spark, {role: f"{folder}/role={role}/*/*.txt" for role in ROLES})
    return textmodel.gram_counts_of_parts(cut_lineage(parts), ORDER)


def language_model_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by role that grew with a stream of turns, a few files at a time."""
    folder = shared_folder(spark, "turns")
    views.table(spark, sf_dir, "conversations").select(F.col("role").alias("label"), "text").repartition(6).write.parquet(folder)
    turns = spark.readStream.schema("label string, text string").option("maxFilesPerTrigger", 2).parquet(folder)
    store = modelstore.ModelStore(spark, shared_folder(spark, "model"), ORDER)
    store.follow(turns)
    return store.gram_counts()


def char_context_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textmodel.context_counts(char_gram_counts(spark, sf_dir), ORDER)


def alphabet_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textmodel.alphabet_sizes(char_gram_counts(spark, sf_dir))


def language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = textmodel.train(_by_lang(spark, sf_dir), ORDER, LANGS)
    return textmodel.score(model, _turns(spark, sf_dir)).select(
        "doc_id", "label", F.round("score", 6).alias("score")
    )


def language_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = textmodel.train(_by_lang(spark, sf_dir), ORDER, LANGS)
    best = textmodel.attribute(model, _turns(spark, sf_dir))
    return best.withColumn("best_score", F.round("best_score", 6))


def role_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.texts(spark, sf_dir, "documents", "doc_id", "text")
    best = textmodel.identify(_by_role(spark, sf_dir), docs, ORDER, ROLES)
    return best.withColumn("best_score", F.round("best_score", 6))


QUERIES = {
    "char_gram_counts": char_gram_counts,
    "char_gram_counts_of_parts": char_gram_counts_of_parts,
    "gram_counts_of_files": gram_counts_of_files,
    "language_model_grown": language_model_grown,
    "char_context_counts": char_context_counts,
    "alphabet_size": alphabet_size,
    "language_scores": language_scores,
    "language_attribution": language_attribution,
    "role_attribution": role_attribution,
}


def _grams(name: str, key: str, source: str) -> str:
    return f"""{name}_text AS MATERIALIZED (
        SELECT {key} AS key, string_split(right(text, {ORDER}) || text, '') AS ring
        FROM {source} WHERE length(text) >= {ORDER}),
    {name}_pos AS (SELECT key, ring, unnest(range(1, len(ring) - {ORDER} + 1)) AS i FROM {name}_text),
    {name} AS MATERIALIZED (
        SELECT key, {' || '.join(f'ring[i + {d}]' for d in range(ORDER + 1))} AS gram, count(*) AS n
        FROM {name}_pos GROUP BY ALL)"""


def _contexts(name: str) -> str:
    return f"""{name}_ctx AS MATERIALIZED (
        SELECT key, left(gram, {ORDER}) AS context, sum(n)::BIGINT AS n FROM {name} GROUP BY ALL),
    {name}_abc AS MATERIALIZED (
        SELECT key, count(DISTINCT right(gram, 1)) AS n_chars FROM {name} GROUP BY key)"""


def _scores(labels: tuple[str, ...]) -> str:
    rows = ", ".join(f"('{name}', {i})" for i, name in enumerate(labels))
    return f"""labels_in_order(label, label_pos) AS (VALUES {rows}),
    scored AS MATERIALIZED (
        SELECT d.key AS doc_id, l.label, l.label_pos,
               sum(d.n * ln((coalesce(g.n, 0) + 1) / (coalesce(c.n, 0) + a.n_chars))) / sum(d.n) AS score
        FROM tested d CROSS JOIN labels_in_order l
        JOIN model_abc a ON a.key = l.label
        LEFT JOIN model g ON g.key = l.label AND g.gram = d.gram
        LEFT JOIN model_ctx c ON c.key = l.label AND c.context = left(d.gram, {ORDER})
        GROUP BY ALL)"""


_BEST = """SELECT doc_id, first(label ORDER BY round(score, 12) DESC, label_pos DESC) AS best_label,
                  round(max(score), 6) AS best_score FROM scored GROUP BY doc_id"""


def _sql(model: tuple[str, str], tested: tuple[str, str] | None, labels: tuple[str, ...], body: str) -> str:
    parts = [_grams("model", *model), _contexts("model")]
    if tested is not None:
        parts += [_grams("tested", *tested), _scores(labels)]
    return "WITH " + ",\n".join(parts) + "\n" + body


_ROLE_MODEL = ("role", "conversations")
_LANG_MODEL = ("lang", "documents")
_TURN_TEXTS = ("conv_id::VARCHAR || '-' || turn::VARCHAR", "conversations")
_DOC_TEXTS = ("doc_id", "documents")

SQL = {
    "char_gram_counts": _sql(_ROLE_MODEL, None, (), "SELECT key AS label, gram, n FROM model"),
    "char_gram_counts_of_parts": _sql(_ROLE_MODEL, None, (), "SELECT key AS label, gram, n FROM model"),
    "gram_counts_of_files": _sql(
        ("role", "files"), None, (), "SELECT key AS label, gram, n FROM model"
    ).replace("WITH ", f"""WITH files AS MATERIALIZED (
        SELECT role, regexp_replace(string_agg(coalesce(text, '') || chr(10), '' ORDER BY conv_id, turn),
                                    chr(13) || chr(10) || '?', chr(10), 'g') AS text
        FROM conversations WHERE role IN {ROLES} GROUP BY role, conv_id // {FILE_CONVERSATIONS}), """, 1),
    "language_model_grown": _sql(_ROLE_MODEL, None, (), "SELECT key AS label, gram, n FROM model"),
    "char_context_counts": _sql(_ROLE_MODEL, None, (), "SELECT key AS label, context, n FROM model_ctx"),
    "alphabet_size": _sql(_ROLE_MODEL, None, (), "SELECT key AS label, n_chars FROM model_abc"),
    "language_scores": _sql(
        _LANG_MODEL, _TURN_TEXTS, LANGS, "SELECT doc_id, label, round(score, 6) AS score FROM scored"
    ),
    "language_attribution": _sql(_LANG_MODEL, _TURN_TEXTS, LANGS, _BEST),
    "role_attribution": _sql(_ROLE_MODEL, _DOC_TEXTS, ROLES, _BEST),
}
