import math

import pytest
from pyspark.sql import functions as F

from corpuslink.functions.geo import great_circle_metres, register_time_between, walking_minutes
from corpuslink.operators.search import (
    building_location,
    distances_from,
    facet_lists,
    find_courses,
    plain_headers,
)
from corpuslink.sources.tables import COURSE_SCHEMAS, read_course_tables, read_index, write_facet_lists, write_index
from tests.conftest import rows


@pytest.fixture(scope="module")
def tables(spark):
    data = {
        "courses": [(1, "AAA", 100, "Red Widget"), (2, "AAA", 200, "Red"), (3, "BBB", 300, "Widget")],
        "sections": [(1, 11, 1, "X", 30), (1, 12, 2, "Y", 10), (2, 21, 1, "Y", 25), (3, 31, 3, "Z", 50)],
        "meeting_patterns": [(1, "MWF", 930, 1020), (2, "TR", 1100, 1220), (3, "-1", 0, 0)],
        "gps": [("X", 0.0, 0.0), ("Y", 0.001, 0.0), ("Z", 1.0, 1.0)],
        "catalog_index": [(1, "red"), (1, "widget"), (2, "red"), (3, "widget"), (3, "widget")],
    }
    return {name: spark.createDataFrame(data[name], schema) for name, schema in COURSE_SCHEMAS.items()}


def test_columns_grow_with_the_criteria(tables):
    section = ["dept", "course_num", "section_num", "day", "time_start", "time_end"]
    assert find_courses(tables, {"day": ["MWF"]}).columns == section
    assert find_courses(tables, {"dept": "AAA"}).columns == ["dept", "course_num", "title"]
    near = find_courses(tables, {"building": "X", "walking_time": 5, "enroll_lower": 1, "dept": "AAA"})
    assert near.columns == [*section, "building_code", "walking_time", "enrollment", "title"]


def test_filters(tables):
    assert rows(find_courses(tables, {"day": ["MWF", "TR"], "time_end": 1100})) == [
        ("AAA", 100, 11, "MWF", 930, 1020),
        ("AAA", 200, 21, "MWF", 930, 1020),
    ]
    assert [r.section_num for r in find_courses(tables, {"enroll_lower": 26, "enroll_upper": 40}).collect()] == [11]
    assert find_courses(tables, {"time_start": 1000}).count() == 1


def test_terms(tables):
    # rows are counted, so a word indexed twice passes for two terms
    assert sorted(r.course_num for r in find_courses(tables, {"terms": "red widget"}).collect()) == [100, 300]
    assert find_courses(tables, {"terms": "red red"}).count() == 0
    assert find_courses(tables, {"terms": "red  widget"}).count() == 0
    assert find_courses(tables, {"terms": "RED"}).count() == 0
    assert find_courses(tables, {"terms": "RED"}, lower_terms=True).count() == 2
    assert find_courses(tables, {"terms": "red red"}, match="division").count() == 2
    # repeated index rows drop a course in literal mode, per section here
    assert rows(find_courses(tables, {"terms": "red widget", "day": ["MWF", "TR"]}).select("section_num")) == [(11,), (12,)]
    # a single term returns one row per index row
    assert find_courses(tables, {"terms": "widget"}).count() == 3
    # two terms against the doubled row: the count of rows decides
    assert [r.course_num for r in find_courses(tables, {"terms": "widget none"}).collect()] == [300]


def test_rejected_criteria(tables):
    for bad in ({}, {"building": "X"}, {"walking_time": 3}, {"day": []}, {"colour": "red"}):
        with pytest.raises(ValueError):
            find_courses(tables, bad)


def test_walking(spark, tables):
    found = {r.building_code: r.walking_time for r in distances_from(tables["gps"], "X").collect()}
    assert found["X"] == 0 and math.isclose(found["Y"], 1.683714, abs_tol=1e-6)
    one = spark.range(1).select(great_circle_metres(F.lit(0.0), F.lit(0.0), F.lit(0.001), F.lit(0.0)).alias("m"))
    assert math.isclose(one.first().m, 111.125, abs_tol=1e-3)
    register_time_between(spark)
    by_sql = spark.sql("SELECT time_between(0, 0, 0.001, 0) AS t").first().t
    assert math.isclose(by_sql, found["Y"], rel_tol=1e-12)
    near = find_courses(tables, {"building": "X", "walking_time": 2})
    assert sorted(r.section_num for r in near.collect()) == [11, 12, 21]
    assert distances_from(tables["gps"], "nowhere").count() == 0
    assert tuple(building_location(tables["gps"], "Y").first()) == (0.001, 0.0)
    assert walking_minutes is not None


def test_facets_and_headers(spark, tables, tmp_path):
    facets = facet_lists(tables)
    assert rows(facets["day"]) == [("MWF",), ("TR",)]
    write_facet_lists(facets, str(tmp_path))
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/building_list").collect()) == ["X", "Y", "Z"]
    df = spark.createDataFrame([(1, 2, 3)], "`a.x.y` int, b int, `c.` int")
    assert plain_headers(df).columns == ["x.y", "b", ""]


def test_index_and_tables_round_trip(spark, tables, tmp_path):
    write_index(tables["catalog_index"], f"{tmp_path}/index")
    assert rows(read_index(spark, f"{tmp_path}/index")) == rows(tables["catalog_index"])
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    assert rows(read_course_tables(spark, str(tmp_path))["gps"]) == rows(tables["gps"])


def test_all_terms_return_rows_that_exist(spark, tables):
    twice = spark.createDataFrame(
        [(1, "TR", 900, 1500), (1, "MWF", 1100, 1200)], COURSE_SCHEMAS["meeting_patterns"]
    )
    index = spark.createDataFrame([(1, "red")], COURSE_SCHEMAS["catalog_index"])
    found = find_courses({**tables, "meeting_patterns": twice, "catalog_index": index}, {"terms": "red widget", "time_start": 800})
    assert rows(found.select("day", "time_start", "time_end")) == [("MWF", 1100, 1200)]
