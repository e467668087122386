"""Rows of two kinds dealt by group, the first kind ahead of the second (runs on Spark's shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_then_streamed(held: DataFrame, streamed: DataFrame, group: str, partitions: int) -> DataFrame:
    """Both tables in one, columns of the other kind null, with ``streamed_row`` telling the kind.
    All rows of a ``group`` are in one partition, its ``held`` rows first, so a task that reads on
    keeps the held rows of one group and never more than a batch of the others."""
    both = held.withColumn("streamed_row", F.lit(False)).unionByName(
        streamed.withColumn("streamed_row", F.lit(True)), allowMissingColumns=True
    )
    return both.repartition(partitions, group).sortWithinPartitions(group, "streamed_row")
