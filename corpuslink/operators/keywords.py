"""Keyword index from page blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.functions.html_blocks import BlockShape
from corpuslink.functions.html_events import blocks, events, text_between
from corpuslink.functions.text import course_code, index_words

MAIN_CLASS = "courseblock main"
SUB_CLASS = "courseblock subsequence"


def page_blocks(pages: DataFrame, shape: BlockShape = BlockShape(), marker: str | None = None) -> DataFrame:
    """Blocks of every page, ``block_no`` in document order, read without leaving the JVM.

    Pages whose text lacks ``marker`` (part of a class name), if given, are left out in the scan."""
    source = pages.select("page_id", "html")
    if marker is not None:
        source = source.where(F.col("html").contains(marker))
    # Outer, as Spark would work the blocks out a second time to filter for those that are not empty.
    found = (
        source.select("page_id", events(F.col("html"), shape).alias("events"))
        .withColumn("found", blocks(F.col("events"), shape))
        .select("page_id", "events", F.posexplode_outer("found").alias("block_no", "block"))
        .where(F.col("block_no").isNotNull())
    )
    part = lambda first, last: text_between(F.col("events"), F.col(f"block.{first}"), F.col(f"block.{last}"))
    return found.select(
        "page_id", "block_no", F.col("block.class").alias("class"), part("t0", "t1").alias("title"),
        part("d0", "d1").alias("desc"), F.col("block.adjacent").alias("prev_adjacent"), F.col("block.blank").alias("prev_blank"),
    )


def block_words(blocks: DataFrame, lower_first: bool = False) -> DataFrame:
    """Add ``words``: the distinct index words of a block's title and description."""
    return blocks.withColumn("words", index_words(F.col("title"), F.col("desc"), lower_first))


def sequence_words(
    blocks: DataFrame,
    main_class: str = MAIN_CLASS,
    sub_class: str = SUB_CLASS,
    strict_adjacent: bool = True,
    lower_first: bool = False,
) -> DataFrame:
    """``(page_id, block_no, title, words)`` of the blocks that get indexed.

    Sub-course blocks right after a header block take the header's words along; a header is
    indexed itself only when no sub-course follows it. ``strict_adjacent=False`` lets blank text
    stand between the blocks. The windows never leave one page.
    """
    words = block_words(blocks.where(F.col("class").isNotNull()), lower_first)
    next_to = F.col("prev_adjacent") if strict_adjacent else F.col("prev_blank")
    follows = (F.col("class") == sub_class) & next_to
    in_page = Window.partitionBy("page_id").orderBy("block_no")
    chained = words.withColumn("follows", follows).withColumn(
        "chain", F.sum(F.when(F.col("follows"), 0).otherwise(1)).over(in_page)
    )
    chain = Window.partitionBy("page_id", "chain").orderBy("block_no")
    whole = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    led = chained.select(
        "page_id",
        "block_no",
        "title",
        "words",
        "follows",
        F.first("class").over(whole).alias("head_class"),
        F.first("words").over(whole).alias("head_words"),
        F.count("*").over(whole).alias("n_blocks"),
    ).where(F.col("head_class") == main_class)
    return led.where(F.col("follows") | (F.col("n_blocks") == 1)).select(
        "page_id", "block_no", "title", F.array_union("head_words", "words").alias("words")
    )


def with_codes(rows: DataFrame, code: Column | None = None) -> DataFrame:
    """Add ``code``, by default the course code in the title (null when there is none)."""
    return rows.withColumn("code", course_code(F.col("title")) if code is None else code)


def index_rows(coded: DataFrame, code_map: DataFrame) -> DataFrame:
    """``(course_id, word)``: one row per block and word, repeats across pages kept."""
    return exploded(coded.join(code_map, "code"), "course_id")


def exploded(rows: DataFrame, *columns: str) -> DataFrame:
    """``(*columns, word)``: one row per word of ``words``. Read outer, so words are worked out once."""
    return rows.select(*columns, F.explode_outer("words").alias("word")).where(F.col("word").isNotNull())


def unknown_codes(coded: DataFrame, code_map: DataFrame) -> DataFrame:
    """Blocks without a code, or with one the map does not know."""
    return coded.join(code_map, "code", "left_anti").drop("words")


def nested_index(index: DataFrame) -> DataFrame:
    """``(word, n_rows, n_courses)``: size of each word's posting list.

    The list itself stays as rows; a frequent word may fill a large part of the index.
    """
    return index.groupBy("word", "course_id").agg(F.count("*").alias("n")).groupBy("word").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_courses")
    )


def build_index(
    pages: DataFrame,
    code_map: DataFrame,
    strict_adjacent: bool = True,
    lower_first: bool = False,
) -> DataFrame:
    """Keyword index ``(course_id, word)`` of catalog pages."""
    blocks = page_blocks(pages, BlockShape(), marker="courseblock")
    return index_rows(
        with_codes(sequence_words(blocks, strict_adjacent=strict_adjacent, lower_first=lower_first)), code_map
    )
