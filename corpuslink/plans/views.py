"""Views that give the sample tables the shapes the operators work on.

Every view reads whole tables. ``VIEW_SQL`` states the same views for the SQL check.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.functions.text import long_word_tokens, word_tokens
from corpuslink.session import cut_lineage
from corpuslink.sources.tables import spread_scan
from corpuslink.sources.wordlist import distinct_words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a text table whose rows are about to be taken apart."""
    return spread_scan(table(spark, sf_dir, name).select(*columns))


# ---------------------------------------------------------------- course search


def courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("course_id"),
        F.col("p_brand").alias("dept"),
        F.col("p_size").alias("course_num"),
        F.col("p_name").alias("title"),
    )


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One section per row, so that filters and columns reach the scan."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("course_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("section_num"),
        F.col("l_orderkey").alias("meeting_pattern_id"),
        F.concat(F.lit("B"), F.col("l_suppkey").cast("string")).alias("building_code"),
        F.col("l_quantity").alias("enrollment"),
    )


def meeting_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.left("o_orderpriority", F.lit(1))
    day = (
        F.when(priority == "1", "MWF")
        .when(priority == "2", "TR")
        .when(priority == "3", "MW")
        .when(priority == "4", "F")
        .otherwise("-1")
    )
    start = (8 + F.col("o_custkey") % 10) * 100 + 30 * (F.col("o_orderkey") % 2)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("meeting_pattern_id"),
        day.alias("day"),
        start.cast("int").alias("time_start"),
        (start + F.when(F.col("o_orderstatus") == "F", 50).otherwise(90)).cast("int").alias("time_end"),
    )


def paired_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meeting patterns of which every odd one has a second row."""
    once = meeting_patterns(spark, sf_dir)
    again = once.where(F.col("meeting_pattern_id") % 2 == 1).select(
        "meeting_pattern_id",
        F.lit("TR").alias("day"),
        (F.col("time_start") - 15).alias("time_start"),
        (F.col("time_end") + 120).alias("time_end"),
    )
    return once.unionByName(again)


def gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("B"), F.col("s_suppkey").cast("string")).alias("building_code"),
        (F.lit(-87.6) + F.lit(0.002) * F.col("s_nationkey")).alias("lon"),
        (F.lit(41.78) + F.lit(0.000003) * F.col("s_acctbal")).alias("lat"),
    )


def catalog_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").alias("course_id"), F.explode(F.split("p_name", " ")).alias("word"))
        .distinct()
    )


def search_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    views = (courses, sections, meeting_patterns, gps, catalog_index)
    return {view.__name__: view(spark, sf_dir) for view in views}


# ---------------------------------------------------------------- dictionary

WORDS_PER_DOCUMENT = 1 << 40


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary of the documents: distinct word tokens, ordered by first appearance (document,
    then place in it). Both make one decimal of 38 digits, which holds any document id and combines
    in a hash aggregation; a minimum over a struct would need a sorted one."""
    document = F.col("doc_id").cast("decimal(20,0)") * F.lit(WORDS_PER_DOCUMENT).cast("decimal(17,0)")
    tokens = texts(spark, sf_dir, "documents", "doc_id", "text").select(
        document.alias("document"), F.posexplode(word_tokens(F.col("text"))).alias("pos", "token")
    )
    return distinct_words(tokens, "token", (F.col("document") + F.col("pos")).cast("decimal(38,0)"), stripped=True)


def stored_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary as a written table, for plans that read it several times."""
    return cut_lineage(words(spark, sf_dir))


def spoken_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        texts(spark, sf_dir, "conversations", "text")
        .select(F.explode(word_tokens(F.col("text"))).alias("word"))
        .distinct()
    )


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "benchmark")
        .select(F.explode(word_tokens(F.col("text"))).alias("word"))
        .distinct()
    )


# ---------------------------------------------------------------- record linkage


#: Where a text has four distinct words of this length, no shorter one is looked at.
LONG_WORD = 10


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per document: its two longest distinct words as name, the next two as address
    (null where there are none), and as city its language with the first letters of the name, so
    that blocks stay small as the data grow and equal texts share one. The whole text is read."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "lang")

    def distinct(words: Column) -> Column:
        return F.array_distinct(F.transform(words, F.lower))

    def first(words: Column) -> Column:
        ranked = F.sort_array(F.transform(words, lambda w: F.struct((-F.char_length(w)).alias("n"), w.alias("w"))))
        return F.slice(ranked, 1, 4)

    docs = docs.select("*", distinct(long_word_tokens(F.col("text"), LONG_WORD)).alias("long"))
    top = F.when(F.size("long") >= 4, first(F.col("long"))).otherwise(first(distinct(word_tokens(F.col("text")))))
    longest = docs.select("doc_id", "lang", top.alias("top"))
    name = F.array_join(F.slice("top.w", 1, 2), " ")
    return longest.select(
        F.col("doc_id").alias("rid"),
        F.nullif(name, F.lit("")).alias("name"),
        F.concat(F.col("lang"), F.lit("-"), F.left(F.coalesce(name, F.lit("")), F.lit(4))).alias("city"),
        F.nullif(F.array_join(F.slice("top.w", 3, 2), " "), F.lit("")).alias("address"),
    )


def record_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records of labelled documents and of the others. The records are written once: several
    steps read them, and each would take the texts apart again."""
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("rid"))
    stored = cut_lineage(records(spark, sf_dir))
    return stored.join(labelled, "rid", "left_semi"), stored.join(labelled, "rid", "left_anti")


def known_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each labelled document with the first unlabelled one of the same text: one link per left
    record, however many copies there are. The hashes are written once: both sides read them."""
    docs = cut_lineage(texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.md5("text").alias("same")))
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    right = docs.join(labelled, "doc_id", "left_anti").groupBy("same").agg(F.min("doc_id").alias("right_id"))
    left = docs.join(labelled, "doc_id", "left_semi").select(F.col("doc_id").alias("left_id"), "same")
    return left.join(right, "same").select("left_id", "right_id")


# ---------------------------------------------------------------- SQL of the same views

_TOKEN = "[a-zA-Z][a-zA-Z0-9]*"

VIEW_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "courses": (
        (),
        "SELECT p_partkey AS course_id, p_brand AS dept, p_size AS course_num, p_name AS title FROM part",
    ),
    "sections": (
        (),
        """SELECT l_partkey AS course_id, l_orderkey * 10 + l_linenumber AS section_num,
                  l_orderkey AS meeting_pattern_id, 'B' || CAST(l_suppkey AS VARCHAR) AS building_code,
                  l_quantity AS enrollment FROM lineitem""",
    ),
    "meeting_patterns": (
        (),
        """SELECT o_orderkey AS meeting_pattern_id,
                  CASE left(o_orderpriority, 1) WHEN '1' THEN 'MWF' WHEN '2' THEN 'TR' WHEN '3' THEN 'MW'
                       WHEN '4' THEN 'F' ELSE '-1' END AS day,
                  CAST((8 + o_custkey % 10) * 100 + 30 * (o_orderkey % 2) AS INTEGER) AS time_start,
                  CAST((8 + o_custkey % 10) * 100 + 30 * (o_orderkey % 2)
                       + CASE WHEN o_orderstatus = 'F' THEN 50 ELSE 90 END AS INTEGER) AS time_end
           FROM orders""",
    ),
    "paired_patterns": (
        ("meeting_patterns",),
        """SELECT * FROM meeting_patterns UNION ALL
           SELECT meeting_pattern_id, 'TR', time_start - 15, time_end + 120 FROM meeting_patterns
           WHERE meeting_pattern_id % 2 = 1""",
    ),
    "gps": (
        (),
        """SELECT 'B' || CAST(s_suppkey AS VARCHAR) AS building_code,
                  CAST(-87.6 AS DOUBLE) + CAST(0.002 AS DOUBLE) * s_nationkey AS lon,
                  CAST(41.78 AS DOUBLE) + CAST(0.000003 AS DOUBLE) * s_acctbal AS lat
           FROM supplier""",
    ),
    "catalog_index": (
        (),
        """SELECT DISTINCT p_partkey AS course_id, word
           FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)""",
    ),
    "word_places": (
        (),
        f"""SELECT doc_id, tok AS toks, generate_subscripts(tok, 1) AS pos
            FROM (SELECT doc_id, regexp_extract_all(text, '{_TOKEN}') AS tok FROM documents)""",
    ),
    "words": (
        ("word_places",),
        """SELECT word, row_number() OVER (ORDER BY first_doc, first_pos) AS line_no
           FROM (SELECT word, min(doc_id) AS first_doc, arg_min(pos, doc_id * 100000000 + pos) AS first_pos
                 FROM (SELECT doc_id, pos, toks[pos] AS word FROM word_places) GROUP BY word)""",
    ),
    "spoken_words": (
        (),
        f"SELECT DISTINCT unnest(regexp_extract_all(text, '{_TOKEN}')) AS word FROM conversations",
    ),
    "benchmark_words": (
        (),
        f"SELECT DISTINCT unnest(regexp_extract_all(text, '{_TOKEN}')) AS word FROM benchmark",
    ),
    "records": (
        (),
        f"""SELECT d.doc_id AS rid, nullif(r.name, '') AS name, nullif(r.address, '') AS address,
                   d.lang || '-' || left(coalesce(r.name, ''), 4) AS city
            FROM documents d LEFT JOIN (
                SELECT doc_id, string_agg(w, ' ' ORDER BY k) FILTER (k <= 2) AS name,
                       string_agg(w, ' ' ORDER BY k) FILTER (k BETWEEN 3 AND 4) AS address
                FROM (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY length(w) DESC, w) AS k
                      FROM (SELECT DISTINCT doc_id, lower(w) AS w FROM (
                          SELECT doc_id, unnest(regexp_extract_all(text, '{_TOKEN}')) AS w FROM documents)))
                GROUP BY doc_id) r ON d.doc_id = r.doc_id""",
    ),
    "left_records": (("records",), "SELECT * FROM records WHERE rid IN (SELECT doc_id FROM labels)"),
    "right_records": (("records",), "SELECT * FROM records WHERE rid NOT IN (SELECT doc_id FROM labels)"),
    "known_links": (
        (),
        """SELECT a.doc_id AS left_id, min(b.doc_id) AS right_id
           FROM documents a JOIN documents b ON a.text = b.text
           WHERE a.doc_id IN (SELECT doc_id FROM labels) AND b.doc_id NOT IN (SELECT doc_id FROM labels)
           GROUP BY a.doc_id""",
    ),
    "word_prefixes": (
        ("words",),
        """SELECT word, line_no, left(word, CAST(len AS INTEGER)) AS prefix, len
           FROM (SELECT word, line_no, unnest(range(0, length(word) + 1)) AS len FROM words)""",
    ),
    "keystrokes": (
        ("benchmark_words",),
        """SELECT DISTINCT left(word, CAST(len AS INTEGER)) AS prefix
           FROM (SELECT word, unnest(range(1, length(word) + 1)) AS len FROM benchmark_words)""",
    ),
}


def _ordered(names: Iterable[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _ordered(VIEW_SQL[name][0], seen)
            seen.append(name)
    return seen


def with_views(names: Iterable[str], body: str, extra: str = "") -> str:
    """SQL text of a check: the needed views as common table expressions, then ``body``."""
    parts = [f"{name} AS MATERIALIZED ({VIEW_SQL[name][1]})" for name in _ordered(names, [])]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n" + body
