"""Fetched pages and the course code map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = "page_id bigint, url string, html string"


def usable_pages(pages: DataFrame) -> DataFrame:
    """Pages that were fetched: 403 and 404 answers are left out, a body that could not be read
    counts as empty. A ``status`` column is optional."""
    if "status" in pages.columns:
        pages = pages.where(F.coalesce("status", F.lit(200)).isin(403, 404) == F.lit(False))
    return pages.withColumn("html", F.coalesce("html", F.lit("")))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return usable_pages(spark.read.schema(PAGE_SCHEMA).parquet(path))


def read_code_map(spark: SparkSession, path: str) -> DataFrame:
    """``(code, course_id)`` from JSON objects that map codes to ids."""
    codes = F.from_json("value", "map<string,bigint>")
    return spark.read.text(path, wholetext=True).select(F.explode(codes).alias("code", "course_id"))
