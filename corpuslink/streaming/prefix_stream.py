"""Typed prefixes as a stream, enriched by a static decision table (stateless, no watermark)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuslink.operators.prefix import with_decisions
from corpuslink.session import shared_folder

TYPED_SCHEMA = "prefix string"


def read_typed_prefixes(spark: SparkSession, path: str) -> DataFrame:
    """File stream of prefixes (JSON lines)."""
    return spark.readStream.schema(TYPED_SCHEMA).json(path)


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """Stream over a stored table, whether it is one file or a folder of part files. A table that
    is not there is an error at once."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path + "*")


def decide_stream(typed: DataFrame, decisions: DataFrame) -> DataFrame:
    """Stream-static left join. Pass a written or cached decision table: a static side is planned
    again for every micro-batch."""
    return with_decisions(typed, decisions)


def run_available(stream: DataFrame, folder: str | None = None) -> DataFrame:
    """Run a stream over the input that is there now and read back all that was written.

    Output and offsets lie in ``folder``. Given the same folder again, the query goes on where it
    stopped; without one it takes a new folder below the shared one.
    """
    spark = stream.sparkSession
    folder = folder or shared_folder(spark, "stream")
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
