"""Text files as samples, whole or in parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_text_samples(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``(label, text)``: one row per file found under each label's path, line ends normalised."""
    samples = None
    for label, path in paths.items():
        text = F.regexp_replace("value", "\r\n?", "\n").alias("text")
        rows = spark.read.text(path, wholetext=True).select(F.lit(label).alias("label"), text)
        samples = rows if samples is None else samples.unionByName(rows)
    if samples is None:
        raise ValueError("no labels given")
    return samples


PART_CHARS = 1 << 16


def read_text_parts(spark: SparkSession, paths: dict[str, str], part_chars: int = PART_CHARS) -> DataFrame:
    """The same files as ordered parts: ``(label, text_id, part_no, text)``; the parts of a file
    (``text_id``), in the order of ``part_no``, make up its text, line ends normalised.

    Files are read line by line in as many splits as their size asks for, so a file of any size
    spreads over tasks; only a line has to fit a row. Lines keep their split's start and their place
    in it, which order them in the file. Whether a file ends with a line end or begins with a byte
    order mark, which the reader takes off, is told by its size."""
    parts = None
    for label, path in paths.items():
        lines = (
            spark.read.option("lineSep", "\n").text(path)
            .select(
                "value",
                F.col("_metadata.file_path").alias("text_id"),
                F.col("_metadata.file_size").alias("size"),
                F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("row"),
            )
        )
        place = F.struct("start", "row")
        read = F.sum(F.octet_length("value") + 1) - 1
        files = lines.groupBy("text_id").agg(
            F.min(place).alias("first"), F.max(place).alias("last"), (F.max("size") - read).alias("rest")
        )
        open_end = (place == F.col("last")) & F.col("rest").isin(0, 3)
        mark = F.when((place == F.col("first")) & (F.col("rest") >= 3), "\ufeff").otherwise("")
        ended = F.concat(F.regexp_replace("value", "\r$", ""), F.lit("\n"))
        text = F.regexp_replace(F.when(open_end, F.col("value")).otherwise(ended), "\r", "\n")
        split = Window.partitionBy("text_id", "start")
        before = split.orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
        own = (
            lines.join(files, "text_id")
            .select("text_id", "start", "row", F.concat(mark, text).alias("text"))
            .withColumn("piece", F.floor(F.coalesce(F.sum(F.char_length("text")).over(before), F.lit(0)) / part_chars))
            .groupBy("text_id", "start", "piece")
            .agg(F.sort_array(F.collect_list(F.struct("row", "text"))).alias("held"))
            .select(
                F.lit(label).alias("label"), "text_id", F.struct("start", "piece").alias("part_no"),
                F.array_join("held.text", "").alias("text"),
            )
        )
        parts = own if parts is None else parts.unionByName(own)
    if parts is None:
        raise ValueError("no labels given")
    return parts
