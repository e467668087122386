"""Posting lists in bounded chunks, and all-terms search on them.

The rows of a keyword index are numbered once in order of word and id; every ``size`` numbers make a
block, and the rows of one word in one block a chunk: ``word, chunk_no, first_id, last_id, n`` and
the ids as differences from the first one. A word of any frequency is a run of chunks over as many
tasks, and a chunk never holds more than ``size`` ids.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.operators.ordering import numbered
from corpuslink.session import cut_lineage

CHUNK_IDS = 256


def posting_chunks(index: DataFrame, id_column: str = "course_id", size: int = CHUNK_IDS) -> DataFrame:
    """``(word, chunk_no, first_id, last_id, n, deltas)`` of an index ``(word, id)``; rows repeat as
    often as in the index. Rows without a word or an id are in no list."""
    rows = index.select("word", F.col(id_column).cast("long").alias("id")).where("word is not null and id is not null")
    blocks = numbered(rows, "word", "id").withColumn("block", F.floor(F.col("pos") / size))
    # At most ``size`` rows a group; the numbered rows are in order, so they combine before the shuffle.
    chunks = blocks.groupBy("word", "block").agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count("*").alias("n"),
        F.sort_array(F.collect_list("id")).alias("ids"),
    )
    starts = blocks.groupBy("word").agg(F.min("block").alias("start"))
    return chunks.join(starts, "word").select(
        "word",
        (F.col("block") - F.col("start")).alias("chunk_no"),
        "first_id",
        "last_id",
        "n",
        F.transform("ids", lambda x: x - F.col("first_id")).alias("deltas"),
    )


def unnested(chunks: DataFrame, id_column: str = "course_id") -> DataFrame:
    """The index rows ``(id, word)`` that the chunks hold."""
    return chunks.select(
        F.explode(F.transform("deltas", lambda d: d + F.col("first_id"))).alias(id_column), "word"
    )


def _ids(chunks: DataFrame) -> DataFrame:
    """Chunks as ``(first_id, last_id, ids)`` without repeats inside a chunk."""
    ids = F.array_distinct(F.transform("deltas", lambda d: d + F.col("first_id")))
    return chunks.select("first_id", "last_id", ids.alias("ids"))


def _common(a: DataFrame, b: DataFrame, origin: int, width: int) -> DataFrame:
    """Ids that both sides hold, as chunks. Chunks meet in the cells of ``width`` ids that their
    ranges touch, and only in the first cell that both touch."""

    def in_cells(chunks: DataFrame, side: str) -> DataFrame:
        cell = lambda c: F.floor((F.col(c) - origin) / width)
        named = chunks.select(*[F.col(c).alias(f"{c}_{side}") for c in chunks.columns])
        return named.withColumn("cell", F.explode(F.sequence(cell(f"first_id_{side}"), cell(f"last_id_{side}"))))

    first = F.greatest("first_id_a", "first_id_b")
    met = in_cells(a, "a").join(in_cells(b, "b"), "cell").where(
        (first <= F.least("last_id_a", "last_id_b")) & (F.col("cell") == F.floor((first - origin) / width))
    )
    both = met.select(F.array_intersect("ids_a", "ids_b").alias("ids")).where(F.size("ids") > 0)
    return both.select(F.array_min("ids").alias("first_id"), F.array_max("ids").alias("last_id"), "ids")


def holding_all(chunks: DataFrame, terms: Iterable[str], id_column: str = "course_id") -> DataFrame:
    """Distinct ids whose rows hold every one of ``terms``.

    The lists are intersected chunk by chunk, the rarest word first; chunks whose id ranges do not
    overlap never meet. One row per term reaches the driver."""
    wanted = sorted(set(terms))
    if not wanted:
        raise ValueError("at least one term is needed")
    spark = chunks.sparkSession
    own = chunks.where(F.col("word").isin(wanted))
    sizes = own.groupBy("word").agg(
        F.sum("n").alias("n"), F.count("*").alias("n_chunks"), F.min("first_id").alias("low"), F.max("last_id").alias("high")
    ).collect()
    if len(sizes) < len(wanted):
        return spark.createDataFrame([], f"{id_column} bigint")
    sizes.sort(key=lambda r: (r["n"], r["word"]))
    origin = min(r["low"] for r in sizes)
    width = max(1, (max(r["high"] for r in sizes) - origin) // max(r["n_chunks"] for r in sizes) + 1)
    lists = {r["word"]: _ids(own.where(F.col("word") == r["word"])) for r in sizes}
    found = lists[sizes[0]["word"]]
    for r in sizes[1:]:
        found = cut_lineage(_common(found, lists[r["word"]], origin, width))
    return found.select(F.explode("ids").alias(id_column)).distinct()
