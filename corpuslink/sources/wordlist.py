"""Word list files: one word per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.functions.text import strip


def distinct_words(
    lines: DataFrame, text: str | Column, order: str | Column | None = None, stripped: bool = False
) -> DataFrame:
    """Dictionary ``(word[, line_no])``: stripped lines, blanks and repeats dropped.

    ``order`` is any orderable expression; the smallest one per word is kept as ``line_no``.
    ``stripped`` lines, such as word tokens, have no blanks at their ends to look for.
    """
    text = F.col(text) if isinstance(text, str) else text
    order = F.col(order) if isinstance(order, str) else order
    columns = [(text if stripped else strip(text)).alias("word")] + ([] if order is None else [order.alias("line_no")])
    words = lines.select(*columns).where(F.col("word") != "")
    if order is None:
        return words.distinct()
    return words.groupBy("word").agg(F.min("line_no").alias("line_no"))


def read_word_list(spark: SparkSession, path: str, with_order: bool = True) -> DataFrame:
    """Dictionary from text files.

    The line order is (file, split start, row within split), which Spark knows for every
    split without numbering the file in one task.
    """
    lines = spark.read.text(path)
    if not with_order:
        return distinct_words(lines, "value")
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return distinct_words(lines.select("value", place.alias("place")), "value", "place")
