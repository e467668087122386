"""Record files for linkage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RECORD_SCHEMA = "rid bigint, name string, city string, address string"
LINK_SCHEMA = "left_id bigint, right_id bigint"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV: id, name, city, address. Values stay as they are (entities, blanks)."""
    return spark.read.schema(RECORD_SCHEMA).option("header", False).csv(path)


def read_known_links(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV of true pairs."""
    return spark.read.schema(LINK_SCHEMA).option("header", False).csv(path)
