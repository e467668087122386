"""Registered round trips: a given table written by the library's outputs or in the format of a
reader, and read back by that reader. What comes back has to equal the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators import search
from corpuslink.plans import views
from corpuslink.plans.views import with_views
from corpuslink.session import shared_folder
from corpuslink.sources import pages, records, tables, textfiles, wordlist

#: Rows of a table in one whole file.
FILE_ROWS = 10_000


def records_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "records")
    suppliers = views.table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.concat(F.lit("N"), F.col("s_nationkey").cast("string")), F.lit("12 Quay, East")
    )
    suppliers.write.option("header", False).csv(folder)
    return records.read_records(spark, folder)


def links_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "links")
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    orders.write.option("header", False).csv(folder)
    return records.read_known_links(spark, folder)


def code_map_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per file, a file per range of keys."""
    folder = shared_folder(spark, "codes")
    code = F.concat_ws(" ", F.lit("CODE"), F.col("p_partkey").cast("string"))
    group = F.floor(F.col("p_partkey") / FILE_ROWS).alias("g")
    entry = F.map_from_entries(F.collect_list(F.struct(code, "p_partkey")))
    objects = views.table(spark, sf_dir, "part").groupBy(group).agg(F.to_json(entry).alias("value"))
    objects.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return pages.read_code_map(spark, f"{folder}/*.txt").select("code", "course_id")


def text_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of whole files of bounded length per role, compared by lines and characters."""
    folder = shared_folder(spark, "samples")
    turns = views.table(spark, sf_dir, "conversations").select(
        "role", F.regexp_replace("text", "[\r\n]", " ").alias("value")
    )
    turns.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("role").text(folder)
    got = textfiles.read_text_samples(spark, {r: f"{folder}/role={r}/*.txt" for r in ("user", "assistant")})
    lines = got.select("label", F.explode(F.split(F.regexp_replace("text", r"\n\z", ""), "\n")).alias("line"))
    return lines.groupBy("label").agg(F.count("*").alias("n_lines"), F.sum(F.char_length("line")).alias("n_chars"))


def word_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "words")
    names = views.table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("value"))
    names.select(F.concat(F.lit("  "), "value", F.lit("\t"))).write.text(folder)
    return wordlist.read_word_list(spark, folder).select("word")


def index_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "index")
    tables.write_index(views.catalog_index(spark, sf_dir), folder)
    return tables.read_index(spark, folder)


def facet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "facets")
    tables.write_facet_lists(search.facet_lists(views.search_tables(spark, sf_dir)), folder)
    found = None
    for name in ("dept", "day", "building"):
        part = spark.read.schema("value string").option("sep", "|").csv(f"{folder}/{name}_list")
        part = part.select(F.lit(name).alias("facet"), "value")
        found = part if found is None else found.unionByName(part)
    return found


def usable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with an answer code by number, some without a body."""
    folder = shared_folder(spark, "pages")
    fetched = views.table(spark, sf_dir, "pages").select(
        "page_id", "url", F.when(F.col("page_id") % 5 > 0, F.col("html")).alias("html")
    )
    fetched.write.parquet(folder)
    answers = F.element_at(F.array(*map(F.lit, (200, 404, 403, 500))), (F.col("page_id") % 4 + 1).cast("int"))
    usable = pages.usable_pages(pages.read_pages(spark, folder).withColumn("status", answers))
    return usable.select("page_id", "url", F.char_length("html").cast("long").alias("n_chars"), "status")


def search_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five tables written under prefixed headers, renamed and searched."""
    folder = shared_folder(spark, "tables")
    for name, table in views.search_tables(spark, sf_dir).items():
        named = table.toDF(*[f"{name}.{c}" for c in table.columns])
        kept = search.plain_headers(named)
        if name == "sections":
            kept = kept.withColumn("enrollment", F.col("enrollment").cast("int"))
        kept.write.parquet(f"{folder}/{name}.parquet")
    stored = tables.read_course_tables(spark, folder)
    return search.find_courses(stored, {"enroll_lower": 10, "enroll_upper": 30})


QUERIES = {
    "records_csv": records_csv,
    "links_csv": links_csv,
    "code_map_json": code_map_json,
    "text_samples": text_samples,
    "word_list_file": word_list_file,
    "index_csv": index_csv,
    "facet_files": facet_files,
    "usable_pages": usable_pages,
    "search_tables": search_tables,
}

SQL = {
    "records_csv": """SELECT s_suppkey AS rid, s_name AS name, 'N' || s_nationkey AS city, '12 Quay, East' AS address
                      FROM supplier""",
    "links_csv": "SELECT o_orderkey AS left_id, o_custkey AS right_id FROM orders",
    "code_map_json": "SELECT 'CODE ' || p_partkey AS code, p_partkey AS course_id FROM part",
    "text_samples": """SELECT role AS label, count(*) AS n_lines, CAST(sum(length(text)) AS BIGINT) AS n_chars
                       FROM conversations WHERE role IN ('user', 'assistant') GROUP BY role""",
    "word_list_file": "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part",
    "index_csv": with_views(("catalog_index",), "SELECT course_id, word FROM catalog_index"),
    "facet_files": with_views(
        ("courses", "meeting_patterns", "gps"),
        """SELECT DISTINCT 'dept' AS facet, dept AS value FROM courses UNION ALL
           SELECT DISTINCT 'day', day FROM meeting_patterns WHERE day <> '-1' UNION ALL
           SELECT DISTINCT 'building', building_code FROM gps""",
    ),
    "usable_pages": """SELECT page_id, url, CASE WHEN page_id % 5 > 0 THEN length(html) ELSE 0 END AS n_chars,
                              [200, 404, 403, 500][CAST(page_id % 4 + 1 AS INTEGER)] AS status
                       FROM pages WHERE page_id % 4 NOT IN (1, 2)""",
    "search_tables": with_views(
        ("courses", "sections", "meeting_patterns"),
        """SELECT c.dept, c.course_num, s.section_num, m.day, m.time_start, m.time_end,
                  CAST(trunc(s.enrollment) AS INTEGER) AS enrollment
           FROM courses c JOIN sections s ON c.course_id = s.course_id
           JOIN meeting_patterns m ON s.meeting_pattern_id = m.meeting_pattern_id
           WHERE trunc(s.enrollment) BETWEEN 10 AND 30""",
    ),
}
