"""Prefix dictionary: counts, completions, decisions, membership, suggestions.

A dictionary is a DataFrame ``(word, line_no)`` with distinct words; ``line_no`` is any
orderable value that tells in which order the words were first listed. The prefix index has
one row per distinct prefix. Completions and decisions for given prefixes come from the intervals
of a numbered dictionary; all lookups are equi joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.functions.text import nearby_keys, word_tokens
from corpuslink.operators.prefix_intervals import NumberedWords, covered, in_chunks, words_and_spans
from corpuslink.session import cut_lineage

MAX_LISTED = 10
MAX_SUGGESTED = 20


def _with_prefixes(words: DataFrame, shortest: int = 0) -> DataFrame:
    """One row per word and prefix of it, from length ``shortest`` to the whole word."""
    lengths = F.sequence(F.lit(shortest), F.char_length("word"))
    prefixes = F.transform(lengths, lambda n: F.left(F.col("word"), n))
    if shortest > 0:
        words = words.where(F.char_length("word") >= shortest)
    return words.select("*", F.explode(prefixes).alias("prefix"))


def keystrokes(words: DataFrame) -> DataFrame:
    """Distinct non-empty prefixes a user passes through while typing the given words."""
    return _with_prefixes(words.select("word").distinct(), 1).select("prefix").distinct()


def prefix_index(words: DataFrame) -> DataFrame:
    """``(prefix, n_words, is_word)``: one row per prefix of any word.

    Counts combine map-side, so the empty prefix (every word) costs no more than any other.
    """
    return (
        _with_prefixes(words.select("word"))
        .groupBy("prefix")
        .agg(
            F.count("*").alias("n_words"),
            F.max(F.col("prefix") == F.col("word")).alias("is_word"),
        )
    )


def completions(words: DataFrame | NumberedWords, prefixes: DataFrame) -> DataFrame:
    """``(prefix, word, suffix)``: one row per asked prefix and word that starts with it.

    Rows, not lists: a short prefix may complete to a large part of the dictionary. For several
    lookups number the words once and pass them."""
    index = words if isinstance(words, NumberedWords) else words.select("word")
    return covered(*words_and_spans(index, prefixes)).select("prefix", "word", _suffix())


def _suffix() -> Column:
    return F.expr("substring(word, length(prefix) + 1)").alias("suffix")


def _tree_steps(words: DataFrame) -> DataFrame:
    """Per prefix: how far listing order moves when passing through it (``jump``) and where
    it stands among the words right below its parent (``land``).

    Order below any prefix: first the words one letter longer, then the longer words letter by
    letter, letters in order of first appearance. The window groups are the letters that follow
    one prefix, so their size is bounded by the alphabet.
    """
    nodes = (
        _with_prefixes(words.select("word", "line_no"), 1)
        .groupBy("prefix")
        .agg(
            F.min("line_no").alias("first_line"),
            F.count("*").alias("n_words"),
            F.max((F.col("prefix") == F.col("word")).cast("long")).alias("ends"),
        )
        .withColumn("parent", F.expr("left(prefix, length(prefix) - 1)"))
    )
    siblings = Window.partitionBy("parent")
    earlier = siblings.orderBy("first_line").rowsBetween(Window.unboundedPreceding, -1)
    deeper = F.col("n_words") - F.col("ends")
    return nodes.select(
        "prefix",
        "ends",
        deeper.alias("deeper"),
        (F.sum("ends").over(siblings) + F.coalesce(F.sum(deeper).over(earlier), F.lit(0))).alias("jump"),
        F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("land"),
    )


def _depth_offsets(steps: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``(word, passed)``: sum of jumps over all prefixes of each given string."""
    return (
        _with_prefixes(prefixes, 1)
        .join(steps.select("prefix", "jump"), "prefix")
        .groupBy("word")
        .agg(F.sum("jump").alias("passed"))
    )


def tree_positions(words: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``(word, tree_pos)`` of all words, or of the ``wanted`` ones: sorting the words below any prefix by ``tree_pos`` (the prefix
    itself first) gives the order in which a prefix tree lists them.

    The position is a sum of per-prefix offsets, so no window ever spans the whole dictionary.
    """
    steps = cut_lineage(_tree_steps(words))
    return _positions(steps, words if wanted is None else wanted)


def _positions(steps: DataFrame, words: DataFrame) -> DataFrame:
    own = steps.withColumnRenamed("prefix", "word")
    return (
        _depth_offsets(steps, words.select("word"))
        .join(own, "word")
        .select("word", (F.col("passed") - F.col("jump") + F.col("land")).alias("tree_pos"))
    )


@dataclass(frozen=True)
class TreeWords:
    """A written dictionary in listing order: ``words`` (``word``, ``pos``, ``chunk``) and the
    ``steps`` of every prefix."""

    words: DataFrame
    steps: DataFrame


def tree_words(words: DataFrame) -> TreeWords:
    """Number a dictionary in listing order."""
    steps = cut_lineage(_tree_steps(words))
    return TreeWords(cut_lineage(in_chunks(_positions(steps, words).withColumnRenamed("tree_pos", "pos"))), steps)


def ordered_completions(words: DataFrame | TreeWords, prefixes: DataFrame) -> DataFrame:
    """``(prefix, word, suffix, position)``: completions with their 0-based listing position.

    The words longer than a prefix are one interval of the listing order; the prefix itself, if it
    is a word, comes first."""
    index = words if isinstance(words, TreeWords) else tree_words(words)
    asked = prefixes.select(F.col("prefix").alias("word")).where(F.col("prefix").isNotNull()).distinct()
    passed = _depth_offsets(index.steps, asked).withColumnRenamed("word", "prefix")
    found = index.steps.select("prefix", "ends", "deeper").join(passed, "prefix")
    everything = index.words.agg(F.count("*").alias("deeper")).join(asked.where("word = ''"))  # at most one row
    spans = cut_lineage(
        found.select("prefix", F.col("passed").alias("low"), (F.col("passed") + F.col("deeper")).alias("high"), "ends")
        .unionByName(
            everything.select(
                F.lit("").alias("prefix"), F.lit(0).cast("long").alias("low"), F.col("deeper").alias("high"),
                F.lit(0).cast("long").alias("ends"),
            )
        )
    )
    longer = covered(index.words, spans).select("prefix", "word", (F.col("pos") - F.col("low") + F.col("ends")).alias("position"))
    own = spans.where("ends = 1").select("prefix", F.col("prefix").alias("word"), F.lit(0).cast("long").alias("position"))
    return longer.unionByName(own).select("prefix", "word", _suffix(), "position")


def _in_tree_order(prefix: Column, held: Column) -> Column:
    """Words of one prefix in listing order: letter by letter, a word that ends there before longer
    ones, then by the first line of the longer prefix, which the words held here tell."""
    depth = F.char_length(prefix)

    def steps(word: Column) -> Column:
        def step(n: Column) -> Column:
            same = F.filter(held, lambda x: F.left(x["word"], n) == F.left(word, n))
            first = F.array_min(F.transform(same, lambda x: x["line_no"]))
            return F.struct((n < F.char_length(word)).alias("inner"), first.alias("first"))

        return F.transform(F.filter(F.sequence(depth, F.char_length(word)), lambda n: n > depth), step)

    keyed = F.transform(held, lambda w: F.struct(steps(w["word"]).alias("steps"), w["word"].alias("word")))
    return F.transform(F.array_sort(keyed), lambda k: k["word"])


def decision_table(words: DataFrame, prefixes: DataFrame | None = None) -> DataFrame:
    """Decision for every prefix that has completions: ``(prefix, n, status, candidates,
    resolved_word)``.

    One completion is ``accepted``, up to ten are a ``list`` (the candidates, in tree order when
    the dictionary has ``line_no``), more only a ``count_only``. Lists are collected only for
    prefixes whose count is already known to be at most ten. ``prefixes`` limits the table to
    the prefixes asked for, whose counts and words come from the intervals of the numbered words.
    """
    lines = F.col("line_no") if "line_no" in words.columns else F.lit(0)
    listed = words.select("word", lines.alias("line_no"))
    few = F.col("n_words").between(1, MAX_LISTED)
    if prefixes is not None:
        placed, spans = words_and_spans(listed, prefixes)
        index = cut_lineage(spans)
        members = covered(placed, index.where(few))
    else:
        index = prefix_index(words)
        members = _with_prefixes(listed).join(index.where(few).select("prefix"), "prefix")
    # At most ten words a prefix: all that share a longer prefix are in its group.
    lists = (
        members.groupBy("prefix")
        .agg(F.collect_list(F.struct("word", "line_no")).alias("held"))
        .select("prefix", _in_tree_order(F.col("prefix"), F.col("held")).alias("candidates"))
    )
    n = F.col("n_words")
    return index.join(lists, "prefix", "left").select(
        "prefix",
        n.alias("n"),
        F.when(n == 1, "accepted").when(n <= MAX_LISTED, "list").otherwise("count_only").alias("status"),
        F.when(n > 1, F.col("candidates")).alias("candidates"),
        F.when(n == 1, F.get("candidates", F.lit(0))).alias("resolved_word"),
    )


def with_decisions(typed: DataFrame, decisions: DataFrame) -> DataFrame:
    """Left join typed prefixes (batch or stream) to a decision table; no entry is a misspelling."""
    return typed.join(decisions, "prefix", "left").select(
        *typed.columns,
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        F.coalesce("status", F.lit("misspelled")).alias("status"),
        "candidates",
        "resolved_word",
    )


def decide(typed: DataFrame, words: DataFrame) -> DataFrame:
    """Prefix decisions for a batch of typed prefixes."""
    return with_decisions(typed, decision_table(words, typed))


def membership(typed: DataFrame, words: DataFrame) -> DataFrame:
    """Add ``is_word`` to rows with a ``word``; the empty string is never a word."""
    known = words.select("word").where(F.col("word") != "").distinct()
    return typed.join(known.withColumn("known", F.lit(True)), "word", "left").select(
        *typed.columns, F.coalesce("known", F.lit(False)).alias("is_word")
    )


def accepted_messages(lines: DataFrame, words: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Per line the known words in typing order, joined by blanks, and how many were unknown.

    A group holds the tokens of one line only.
    """
    tokens = lines.select(*keys, F.posexplode_outer(word_tokens(F.col(text))).alias("pos", "word"))
    checked = membership(tokens, words)
    kept = F.sort_array(F.collect_list(F.when(F.col("is_word"), F.struct("pos", "word"))))
    return (
        checked.groupBy(*keys)
        .agg(kept.alias("kept"), F.count(F.when(~F.col("is_word"), F.col("word"))).alias("n_unknown"))
        .select(*keys, F.array_join(F.col("kept.word"), " ").alias("message"), "n_unknown")
    )


def keyboard_variants(typed: DataFrame) -> DataFrame:
    """``(word, suggestion)``: each distinct word with one letter replaced by a neighbouring key."""
    words = typed.select("word").where(F.col("word") != "").distinct()
    at = F.sequence(F.lit(1), F.char_length("word"))
    swapped = F.flatten(
        F.transform(
            at,
            lambda i: F.transform(
                nearby_keys(F.substring(F.col("word"), i, F.lit(1))),
                lambda c: F.concat(
                    F.left(F.col("word"), i - 1),
                    c,
                    F.substring(F.col("word"), i + 1, F.char_length("word")),
                ),
            ),
        )
    )
    return words.select("word", F.explode(F.array_distinct(swapped)).alias("suggestion"))


def keyboard_suggestions(typed: DataFrame, words: DataFrame) -> DataFrame:
    """Did-you-mean (an extension of the listing contract): dictionary words one neighbouring key
    away from each typed word, given only when there are 1 to 20 of them.

    A group holds the variants of one word, at most five per letter.
    """
    known = words.select(F.col("word").alias("suggestion"))
    return (
        keyboard_variants(typed)
        .join(known, "suggestion", "left_semi")
        .groupBy("word")
        .agg(F.sort_array(F.collect_list("suggestion")).alias("suggestions"))
        .where(F.size("suggestions") <= MAX_SUGGESTED)
    )


_BLANK = "\x00"


def _wildcards(words: DataFrame) -> DataFrame:
    """``(word, at, key)``: each distinct word with every two places (the only one of a word of one
    letter) blanked, of those that have a neighbouring key. ``at`` holds the places ``i`` and ``j``
    and whether each is the partner of the other: the next place, of the last one the one before."""
    places = F.filter(
        F.sequence(F.lit(1), F.char_length("word")),
        lambda i: F.size(nearby_keys(F.substring(F.col("word"), i, F.lit(1)))) > 0,
    )
    held, word = F.col("places"), F.col("word")
    at = lambda i, j, first, last: F.struct(i.alias("i"), j.alias("j"), first.alias("first"), last.alias("last"))
    pairs = F.flatten(
        F.transform(
            held,
            lambda i, a: F.transform(
                F.slice(held, a + 2, F.size(held)),
                lambda j, b: at(i, j, b == 0, (b == 0) & (a + 2 == F.size(held))),
            ),
        )
    )
    single = F.transform(held, lambda i: at(i, i, F.lit(False), F.lit(False)))
    blanked = F.when(
        F.col("at.i") == F.col("at.j"),
        F.concat(F.left(word, F.col("at.i") - 1), F.lit(_BLANK), F.substring(word, F.col("at.i") + 1, F.char_length(word))),
    ).otherwise(
        F.concat(
            F.left(word, F.col("at.i") - 1), F.lit(_BLANK),
            F.substring(word, F.col("at.i") + 1, F.col("at.j") - F.col("at.i") - 1), F.lit(_BLANK),
            F.substring(word, F.col("at.j") + 1, F.char_length(word)),
        )
    )
    return (
        words.select("word").where(F.col("word") != "").distinct()
        .withColumn("places", places)
        .select("word", F.explode(F.when(F.size("places") < 2, single).otherwise(pairs)).alias("at"))
        .select("word", "at", blanked.alias("key"))
    )


def keyboard_suggestions_two(typed: DataFrame, words: DataFrame) -> DataFrame:
    """Did-you-mean at two keys: dictionary words that differ from a typed word in one or two letters,
    each by a neighbouring key, given only when there are 1 to 20 of them.

    Both sides are blanked at two places and joined by what is left; the letters at the blanks are
    then looked up in the neighbour table. No typed word is expanded into its variants. A key is
    shared by at most as many words as two letters can differ. The join is a merge join on purpose:
    either side has many keys for a word, so the size of its words says nothing of its own."""
    asked = _wildcards(typed)
    known = _wildcards(words).select("key", F.col("word").alias("suggestion"), F.col("at.i").alias("own_i"), F.col("at.j").alias("own_j"))
    letter = lambda word, place: F.substring(F.col(word), F.col(place), F.lit(1))
    same = lambda place: letter("word", place) == letter("suggestion", place)
    near = lambda place: F.array_contains(nearby_keys(letter("word", place)), letter("suggestion", place))
    single = F.col("at.i") == F.col("at.j")
    # A word that differs in one letter only is taken with the next place, or the last but one.
    fits = (
        (single & near("at.i"))
        | (~single & near("at.i") & near("at.j"))
        | (F.col("at.first") & near("at.i") & same("at.j"))
        | (F.col("at.last") & same("at.i") & near("at.j"))
    )
    # Both sides must be blanked at the same places: letters with a neighbour keep one when changed.
    met = asked.join(known.hint("merge"), "key").where((F.col("at.i") == F.col("own_i")) & (F.col("at.j") == F.col("own_j")) & fits)
    return (
        met.groupBy("word")
        .agg(F.sort_array(F.collect_list("suggestion")).alias("suggestions"))
        .where(F.size("suggestions") <= MAX_SUGGESTED)
    )
