"""Completions as intervals of a numbered dictionary.

The words are numbered once. In byte order the words below any prefix are neighbours, and in listing
order so are the longer ones, so a prefix is an interval of numbers, the size of the interval is its
count, and its words come by an equi join on chunks of ``CHUNK`` numbers. No word is repeated for
its prefixes, and what is joined grows with the answer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.operators.ordering import numbered, numbered_with_bounds, rank_among

CHUNK = 256


@dataclass(frozen=True)
class NumberedWords:
    """A written dictionary: ``words`` (their columns, ``pos`` and ``chunk``) and, in byte order, the
    first word of every chunk (``chunk``, ``key``)."""

    words: DataFrame
    heads: DataFrame


def in_chunks(words: DataFrame) -> DataFrame:
    """Numbered words with the chunk of their number."""
    return words.withColumn("chunk", F.floor(F.col("pos") / CHUNK))


def number_words(words: DataFrame) -> NumberedWords:
    """Number distinct ``words`` in byte order. They are read twice, so they should be a stored table."""
    stored = in_chunks(numbered(words.where(F.col("word").isNotNull()), "word"))
    heads = stored.where(F.col("pos") % CHUNK == 0).select("chunk", F.col("word").cast("binary").alias("key"))
    return NumberedWords(stored, heads)


def _bounds(prefixes: DataFrame) -> DataFrame:
    """``(prefix, bound)``: each distinct prefix with itself, and with itself and a byte that no text
    holds."""
    low = F.col("prefix").cast("binary")
    asked = prefixes.select("prefix").where(F.col("prefix").isNotNull()).distinct()
    return asked.select("prefix", F.explode(F.array(low, F.concat(low, F.lit(b"\xff")))).alias("bound"))


def intervals(numbered_words: NumberedWords, prefixes: DataFrame) -> DataFrame:
    """``(prefix, low, high)`` of every distinct asked prefix that has words: they are those with
    ``low <= pos < high``.

    The bounds of a prefix are placed among the chunks' first words, then among the words of their
    chunk."""
    sides = _bounds(prefixes)
    chunk = F.greatest(F.lit(0), F.col("rank") - 1)
    placed = rank_among(sides.select("bound"), numbered_words.heads).select("bound", chunk.alias("chunk"))
    words = numbered_words.words.select("chunk", F.col("word").cast("binary").alias("key"))
    smaller = (
        placed.join(words, "chunk").where(F.col("key") < F.col("bound")).groupBy("bound").agg(F.count("*").alias("n"))
    )
    positions = placed.join(smaller, "bound", "left").select(
        "bound", (F.col("chunk") * CHUNK + F.coalesce("n", F.lit(0))).alias("at")
    )
    return (
        sides.join(positions, "bound")
        .groupBy("prefix")
        .agg(F.min("at").alias("low"), F.max("at").alias("high"))
        .where("high > low")
    )


def words_and_spans(words: DataFrame | NumberedWords, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered words, and ``(prefix, low, high, n_words)`` of the asked prefixes that have any.

    Words that are not numbered yet are sorted together with the bounds; they are read twice, so
    they should be a stored table."""
    if isinstance(words, NumberedWords):
        return words.words, intervals(words, prefixes).withColumn("n_words", F.col("high") - F.col("low"))
    keyed = words.where(F.col("word").isNotNull()).withColumn("key", F.col("word").cast("binary"))
    placed, bounds = numbered_with_bounds(keyed, _bounds(prefixes))
    spans = bounds.groupBy("prefix").agg(
        F.min("pos").alias("low"), F.max("pos").alias("high"), (F.max("n_before") - F.min("n_before")).alias("n_words")
    )
    return in_chunks(placed), spans.where("n_words > 0")


def covered(words: DataFrame, spans: DataFrame) -> DataFrame:
    """Each of ``spans`` (with ``low`` and ``high``) with the numbered ``words`` it covers."""
    by_chunk = spans.where("high > low").withColumn(
        "chunk", F.explode(F.sequence(F.floor(F.col("low") / CHUNK), F.floor((F.col("high") - 1) / CHUNK)))
    )
    return by_chunk.join(words, "chunk").where("pos >= low and pos < high").drop("chunk")
