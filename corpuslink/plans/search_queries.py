"""Registered course search queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators import postings, search
from corpuslink.plans import views
from corpuslink.plans.views import with_views

ORIGIN = "B7"
MORNING = {"time_start": 800, "time_end": 1250, "day": ["MWF"]}
BOTH_TERMS = {
    "dept": "Brand#2",
    "day": ["MWF", "MW"],
    "time_start": 900,
    "time_end": 1700,
    "enroll_lower": 12,
    "terms": "red widget",
}
NEARBY = {"building": ORIGIN, "walking_time": 20, "time_start": 900}
REACH = 5
MIDDLE_SIZE = {"enroll_lower": 10, "enroll_upper": 30}


def _find(args: dict, match: str = "literal"):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = search.find_courses(views.search_tables(spark, sf_dir), args, match)
        if "walking_time" in found.columns:
            found = found.withColumn("walking_time", F.round("walking_time", 6))
        return found

    return run


def course_search_paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All terms over sections with two pattern rows: every result is one of their rows."""
    tables = views.search_tables(spark, sf_dir)
    tables["meeting_patterns"] = views.paired_patterns(spark, sf_dir)
    return search.find_courses(tables, {"terms": "red widget", "time_start": 815})


def course_search_by_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All distinct terms, by intersecting the chunks of their posting lists."""
    chunks = postings.posting_chunks(views.catalog_index(spark, sf_dir))
    return search.courses_by_postings(views.courses(spark, sf_dir), chunks, "widget red red")


def building_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = search.distances_from(views.gps(spark, sf_dir), ORIGIN)
    return near.withColumn("walking_time", F.round("walking_time", 6))


def buildings_within_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every building with all others at most five minutes away."""
    near = search.buildings_within_reach(views.gps(spark, sf_dir), REACH)
    return near.withColumn("walking_time", F.round("walking_time", 6))


def building_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.building_location(views.gps(spark, sf_dir), ORIGIN)


def facet_depts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.facet(views.courses(spark, sf_dir), "dept")


def facet_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.facet(views.meeting_patterns(spark, sf_dir), "day", skip="-1")


def facet_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.facet(views.gps(spark, sf_dir), "building_code")


QUERIES = {
    "course_search_time_day": _find(MORNING),
    "course_search_terms_all": _find(BOTH_TERMS),
    "course_search_paired": course_search_paired,
    "course_search_terms_only": _find({"terms": "red widget"}),
    "course_search_terms_division": _find({"terms": "widget red red"}, "division"),
    "course_search_by_postings": course_search_by_postings,
    "course_search_single_term": _find({"terms": "widget"}),
    "course_search_dept": _find({"dept": "Brand#2"}),
    "course_search_walking": _find(NEARBY),
    "course_search_enrollment": _find(MIDDLE_SIZE),
    "building_distances": building_distances,
    "buildings_within_reach": buildings_within_reach,
    "building_location": building_location,
    "facet_depts": facet_depts,
    "facet_days": facet_days,
    "facet_buildings": facet_buildings,
}

_JOINED = """courses c JOIN sections s ON c.course_id = s.course_id
             JOIN meeting_patterns m ON s.meeting_pattern_id = m.meeting_pattern_id"""
_SECTION = "s.section_num, m.day, m.time_start, m.time_end"
_MINUTES = """2 * asin(sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
    + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2)))
    * 6367 * 1000 / (1.1 * 60)"""
_BASIC = ("courses", "sections", "meeting_patterns")

_DIVISION = """SELECT c.dept, c.course_num, c.title FROM courses c WHERE c.course_id IN (
             SELECT course_id FROM catalog_index WHERE word IN ('red', 'widget')
             GROUP BY course_id HAVING count(DISTINCT word) = 2)"""

SQL = {
    "course_search_time_day": with_views(
        _BASIC,
        f"""SELECT c.dept, c.course_num, {_SECTION} FROM {_JOINED}
            WHERE m.day = 'MWF' AND m.time_start >= 800 AND m.time_end <= 1250""",
    ),
    "course_search_terms_all": with_views(
        (*_BASIC, "catalog_index"),
        f"""SELECT section_num, unnest(row) FROM (
                SELECT i.course_id, s.section_num, min(struct_pack(dept := c.dept, course_num := c.course_num,
                       day := m.day, time_start := m.time_start, time_end := m.time_end,
                       enrollment := s.enrollment, title := c.title)) AS row
                FROM {_JOINED} JOIN catalog_index i ON c.course_id = i.course_id
                WHERE (m.day = 'MWF' OR m.day = 'MW') AND m.time_start >= 900 AND m.time_end <= 1700
                  AND s.enrollment >= 12 AND c.dept = 'Brand#2' AND (i.word = 'red' OR i.word = 'widget')
                GROUP BY i.course_id, s.section_num HAVING count(*) = 2)""",
    ),
    "course_search_paired": with_views(
        (*_BASIC, "paired_patterns", "catalog_index"),
        f"""SELECT section_num, unnest(row) FROM (
                SELECT i.course_id, s.section_num, min(struct_pack(dept := c.dept, course_num := c.course_num,
                       day := m.day, time_start := m.time_start, time_end := m.time_end, title := c.title)) AS row
                FROM {_JOINED.replace("meeting_patterns", "paired_patterns")}
                JOIN catalog_index i ON c.course_id = i.course_id
                WHERE m.time_start >= 815 AND (i.word = 'red' OR i.word = 'widget')
                GROUP BY i.course_id, s.section_num HAVING count(*) = 2)""",
    ),
    "course_search_terms_only": with_views(
        ("courses", "catalog_index"),
        """SELECT min(c.dept) AS dept, min(c.course_num) AS course_num, min(c.title) AS title
           FROM courses c JOIN catalog_index i ON c.course_id = i.course_id
           WHERE i.word = 'red' OR i.word = 'widget' GROUP BY i.course_id HAVING count(*) = 2""",
    ),
    "course_search_terms_division": with_views(("courses", "catalog_index"), _DIVISION),
    "course_search_by_postings": with_views(("courses", "catalog_index"), _DIVISION),
    "course_search_single_term": with_views(
        ("courses", "catalog_index"),
        """SELECT c.dept, c.course_num, c.title FROM courses c
           JOIN catalog_index i ON c.course_id = i.course_id WHERE i.word = 'widget'""",
    ),
    "course_search_dept": with_views(
        ("courses",), "SELECT dept, course_num, title FROM courses WHERE dept = 'Brand#2'"
    ),
    "course_search_walking": with_views(
        (*_BASIC, "gps"),
        f"""SELECT c.dept, c.course_num, {_SECTION}, b.building_code, round({_MINUTES}, 6) AS walking_time
            FROM {_JOINED} JOIN gps b ON s.building_code = b.building_code
            JOIN gps a ON a.building_code = '{ORIGIN}'
            WHERE m.time_start >= 900 AND {_MINUTES} <= 20""",
    ),
    "course_search_enrollment": with_views(
        _BASIC,
        f"""SELECT c.dept, c.course_num, {_SECTION}, s.enrollment FROM {_JOINED}
            WHERE s.enrollment >= 10 AND s.enrollment <= 30""",
    ),
    "building_distances": with_views(
        ("gps",),
        f"""SELECT b.building_code, round({_MINUTES}, 6) AS walking_time
            FROM gps a, gps b WHERE a.building_code = '{ORIGIN}'""",
    ),
    "buildings_within_reach": with_views(
        ("gps",),
        f"""SELECT a.building_code AS from_building, b.building_code AS to_building, round({_MINUTES}, 6) AS walking_time
            FROM gps a, gps b WHERE a.building_code <> b.building_code AND {_MINUTES} <= {REACH}""",
    ),
    "building_location": with_views(
        ("gps",), f"SELECT lon, lat FROM gps WHERE building_code = '{ORIGIN}' ORDER BY lon, lat LIMIT 1"
    ),
    "facet_depts": with_views(("courses",), "SELECT DISTINCT dept FROM courses"),
    "facet_days": with_views(
        ("meeting_patterns",), "SELECT DISTINCT day FROM meeting_patterns WHERE day <> '-1'"
    ),
    "facet_buildings": with_views(("gps",), "SELECT DISTINCT building_code FROM gps"),
}
