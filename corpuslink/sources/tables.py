"""Relational inputs and delimited outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

COURSE_SCHEMAS = {
    "courses": "course_id bigint, dept string, course_num int, title string",
    "sections": (
        "course_id bigint, section_num bigint, meeting_pattern_id bigint, "
        "building_code string, enrollment int"
    ),
    "meeting_patterns": "meeting_pattern_id bigint, day string, time_start int, time_end int",
    "gps": "building_code string, lon double, lat double",
    "catalog_index": "course_id bigint, word string",
}


def spread_scan(df: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer splits than the cluster has cores.

    Work that multiplies rows (tokens, grams) would otherwise run in those few tasks. A large
    table already has more splits than cores and is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_course_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five search tables with their fixed schemas (no inference pass)."""
    return {
        name: spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")
        for name, schema in COURSE_SCHEMAS.items()
    }


def write_pipe_delimited(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Headerless text output with ``|`` between fields, one file per partition."""
    df.write.mode(mode).option("sep", "|").option("header", False).csv(path)


def write_index(index: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Keyword index as ``course_id|word`` lines."""
    write_pipe_delimited(index.select("course_id", "word"), path, mode)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COURSE_SCHEMAS["catalog_index"]).option("sep", "|").csv(path)


def write_facet_lists(facets: Mapping[str, DataFrame], folder: str, mode: str = "errorifexists") -> None:
    """One ``<name>_list`` output per facet."""
    for name, values in facets.items():
        write_pipe_delimited(values, f"{folder}/{name}_list", mode)
