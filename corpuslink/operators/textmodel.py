"""Character models: train per label, score texts, pick the most likely label.

A model of order k counts grams of k+1 characters and their k-character contexts over circular
text. Grams combine map-side when they are counted. A model of up to ``MODEL_GRAMS`` grams goes to
the texts: its terms are broadcast, every position looks its term up and the sums combine map-side,
so one row per text and task is shuffled. With a larger model the grams of the texts are counted
and joined to it instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.functions.grams import circular_pieces, context_of, piece_grams, smoothed_log
from corpuslink.session import cut_lineage

#: Distinct grams up to which a model is broadcast. Their number depends on the alphabet, not on the
#: length of the texts.
MODEL_GRAMS = 1 << 18


def _check_order(k: int) -> None:
    if k < 1:
        raise ValueError("the order must be at least 1")


def gram_counts(texts: DataFrame, k: int, keys: Sequence[str] = ("label",)) -> DataFrame:
    """``(*keys, gram, n)``: occurrences of each gram per key."""
    _check_order(k)
    return _counted(texts.select(*keys, F.explode(circular_pieces(F.col("text"), k)).alias("piece")), k, keys)


def _counted(pieces: DataFrame, k: int, keys: Sequence[str]) -> DataFrame:
    return (
        pieces.select(*keys, F.explode(piece_grams(F.col("piece"), k)).alias("gram"))
        .groupBy(*keys, "gram")
        .agg(F.count("*").alias("n"))
    )


def gram_counts_of_parts(
    parts: DataFrame, k: int, keys: Sequence[str] = ("label",), text_id: str = "text_id", order: str = "part_no"
) -> DataFrame:
    """:func:`gram_counts` of texts held in several rows (``text_id``, ``order``, ``text``).

    The k characters before a part come from the parts before it, those before the first one from
    the last; empty parts and texts shorter than k give nothing. Only the ends of the parts, k
    characters each, go through the windows that order the parts of a text; the texts meet them by
    an equi join. ``parts`` is read twice, so it should be a stored table.
    """
    _check_order(k)
    one = Window.partitionBy(*keys, text_id)
    run = one.orderBy(order)
    parts = parts.select(*keys, text_id, order, "text").where(F.char_length("text") > 0)
    tails = parts.select(*keys, text_id, order, F.right("text", F.lit(k)).alias("_tail"), F.char_length("text").alias("_n"))
    # Every part has a character, so k parts hold the last k of them.
    upto = F.right(F.array_join(F.collect_list("_tail").over(run.rowsBetween(1 - k, 0)), ""), F.lit(k))
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = (
        tails.withColumn("_end", upto)
        .withColumn(
            "_before",
            F.right(F.concat(F.last("_end").over(whole), F.coalesce(F.lag("_end").over(run), F.lit(""))), F.lit(k)),
        )
        .withColumn("_total", F.sum("_n").over(one))
        .where(F.col("_total") >= k)
        .select(*keys, text_id, order, "_before")
    )
    led = parts.join(ends, [*keys, text_id, order])
    pieces = circular_pieces(F.col("text"), k, before=F.col("_before"))
    return _counted(led.select(*keys, F.explode(pieces).alias("piece")), k, keys)


def context_counts(grams: DataFrame, k: int, keys: Sequence[str] = ("label",)) -> DataFrame:
    """``(*keys, context, n)`` from gram counts: each position adds one to its gram and context."""
    return (
        grams.select(*keys, context_of(F.col("gram"), k).alias("context"), "n")
        .groupBy(*keys, "context")
        .agg(F.sum("n").alias("n"))
    )


def alphabet_sizes(grams: DataFrame, keys: Sequence[str] = ("label",)) -> DataFrame:
    """``(*keys, n_chars)``: distinct characters, read off the last character of each gram."""
    return (
        grams.select(*keys, F.right("gram", F.lit(1)).alias("last"))
        .distinct()
        .groupBy(*keys)
        .agg(F.count("*").alias("n_chars"))
    )


def too_short(texts: DataFrame, k: int) -> DataFrame:
    """Texts that cannot be used with order k: null, empty or shorter than k."""
    return texts.where(F.coalesce(F.char_length("text"), F.lit(0)) < k)


@dataclass(frozen=True)
class TextModel:
    """Trained model: counts per label. ``labels`` lists the labels, a tie goes to the later one."""

    k: int
    labels: tuple[str, ...]
    grams: DataFrame
    contexts: DataFrame
    alphabet: DataFrame


def train(texts: DataFrame, k: int, labels: Sequence[str], materialize: bool = True) -> TextModel:
    """Train one model per label from ``(label, text)`` rows.

    The gram counts are written to the checkpoint folder once; contexts and alphabet sizes are
    read off that copy instead of taking the texts apart again.
    """
    _check_order(k)
    if len(set(labels)) != len(labels) or not labels:
        raise ValueError("labels must be given, each once")
    grams = gram_counts(texts.where(F.col("label").isin(list(labels))), k)
    if materialize:
        grams = cut_lineage(grams)
    return TextModel(k, tuple(labels), grams, context_counts(grams, k), alphabet_sizes(grams))


def _per_label(counts: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """One row per key with a map from the label's position to its count."""
    place = F.array_position(F.array(*map(F.lit, labels)), F.col("label")) - 1
    entries = F.collect_list(F.struct(place.cast("int").alias("label_pos"), "n"))
    return counts.groupBy(key).agg(F.map_from_entries(entries).alias("counts"))


def gram_terms(model: TextModel, asked: DataFrame) -> DataFrame:
    """``(gram, terms)``: for each asked gram ``(gram, n)`` its log term under every label.

    The terms are worked out once per distinct gram, not once per text. Summing ``n`` keeps the
    shuffle of the counted grams identical to the one the caller joins, so Spark reuses it. The
    number of expressions does not depend on the number of labels.
    """
    grams = asked.groupBy("gram").agg(F.sum("n").alias("n_asked")).where(F.col("n_asked") > 0)
    grams = grams.select("gram", context_of(F.col("gram"), model.k).alias("context"))
    by_label = F.map_from_entries(F.collect_list(F.struct("label", "n_chars")))
    sizes = model.alphabet.agg(by_label.alias("by_label")).select(
        F.transform(F.array(*map(F.lit, model.labels)), lambda name: F.try_element_at("by_label", name)).alias("sizes")
    )
    known = grams.join(
        _per_label(model.grams, "gram", model.labels).withColumnRenamed("counts", "seq"), "gram", "left"
    ).join(
        _per_label(model.contexts, "context", model.labels).withColumnRenamed("counts", "ctx"),
        "context",
        "left",
    )
    count = lambda counts, i: F.coalesce(F.try_element_at(counts, i), F.lit(0))
    terms = F.transform(
        F.col("sizes"), lambda size, i: smoothed_log(count(F.col("seq"), i), count(F.col("ctx"), i), size)
    )
    return known.withColumn("sizes", sizes.scalar()).select("gram", terms.alias("terms"))


def _model_terms(model: TextModel) -> tuple[DataFrame, DataFrame, list[Column]]:
    """``(gram, t0, t1, ..)`` for the grams of the model, ``(context, u0, u1, ..)`` for grams it has
    not seen in a context it has, and the terms in a context it has not; one per label."""
    sizes = {row["label"]: row["n_chars"] for row in model.alphabet.collect()}  # one row per label
    contexts = _per_label(model.contexts, "context", model.labels).withColumnRenamed("counts", "ctx")
    grams = _per_label(model.grams, "gram", model.labels).withColumnRenamed("counts", "seq")
    count = lambda counts, i: F.coalesce(F.try_element_at(counts, F.lit(i)), F.lit(0))
    size = [F.lit(sizes.get(name)).cast("long") for name in model.labels]
    known = grams.withColumn("context", context_of(F.col("gram"), model.k)).join(contexts, "context")
    seen = known.select(
        "gram", *[smoothed_log(count("seq", i), count("ctx", i), n).alias(f"t{i}") for i, n in enumerate(size)]
    )
    unseen = contexts.select(
        "context", *[smoothed_log(F.lit(0), count("ctx", i), n).alias(f"u{i}") for i, n in enumerate(size)]
    )
    nowhere = [smoothed_log(F.lit(0), F.lit(0), n) for n in size]
    return seen, unseen, nowhere


def _sums_by_broadcast(model: TextModel, texts: DataFrame, key: str) -> DataFrame:
    """``(key, n_chars, t0, t1, ..)``: the sums of the terms of every position of a text."""
    seen, unseen, nowhere = _model_terms(model)
    pieces = texts.select(key, F.explode(circular_pieces(F.col("text"), model.k)).alias("piece"))
    positions = pieces.select(key, F.explode(piece_grams(F.col("piece"), model.k)).alias("gram"))
    # Bounded by MODEL_GRAMS, contexts are no more than grams.
    found = positions.join(F.broadcast(cut_lineage(seen).withColumn("is_known", F.lit(True))), "gram", "left")
    asked = F.when(F.col("is_known").isNull(), context_of(F.col("gram"), model.k))
    found = found.withColumn("asked", asked).join(
        F.broadcast(cut_lineage(unseen).withColumnRenamed("context", "asked").withColumn("is_near", F.lit(True))), "asked", "left"
    )
    term = lambda i: (
        F.when(F.col("is_known"), F.col(f"t{i}")).when(F.col("is_near"), F.col(f"u{i}")).otherwise(nowhere[i])
    )
    sums = [F.sum(term(i)).alias(f"t{i}") for i in range(len(model.labels))]
    return found.groupBy(key).agg(F.count("*").alias("n_chars"), *sums)


def _sums_by_join(model: TextModel, texts: DataFrame, key: str) -> DataFrame:
    """The same sums for a model that is too large to be broadcast."""
    counted = gram_counts(texts, model.k, keys=(key,))
    sums = [
        F.sum(F.col("n") * F.get("terms", F.lit(i))).alias(f"t{i}") for i in range(len(model.labels))
    ]
    return (
        counted.join(gram_terms(model, counted), "gram")
        .groupBy(key)
        .agg(F.sum("n").alias("n_chars"), *sums)
    )


def _label_rows(model: TextModel, texts: DataFrame, key: str) -> DataFrame:
    """``(key, rows)``: per text an array with label, position, log probability and score."""
    n_grams = model.grams.select("gram").distinct().count()
    totals = (_sums_by_broadcast if n_grams <= MODEL_GRAMS else _sums_by_join)(model, texts, key)
    rows = [
        F.struct(
            (F.col(f"t{i}") / F.col("n_chars")).alias("score"),
            F.lit(i).alias("label_pos"),
            F.lit(name).alias("label"),
            F.col(f"t{i}").alias("log_prob"),
        )
        for i, name in enumerate(model.labels)
    ]
    return totals.select(key, F.array(*rows).alias("rows"))


def score(model: TextModel, texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, label, label_pos, log_prob, score)``: one row per text and label.

    ``score`` is the log probability per character. Texts shorter than the order are left out
    (see :func:`too_short`).
    """
    rows = _label_rows(model, texts, key).select(key, F.inline("rows"))
    return rows.select(key, "label", "label_pos", "log_prob", "score")


def attribute(model: TextModel, texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, best_label, best_score)``: the label with the highest score per text, a tie goes to
    the later label. Chosen within the row, without another shuffle."""
    best = F.array_max("rows")
    return _label_rows(model, texts, key).select(
        key, best["label"].alias("best_label"), best["score"].alias("best_score")
    )


def best_labels(scores: DataFrame, key: str = "doc_id") -> DataFrame:
    """The same choice for scores kept as rows."""
    rank = F.struct("score", "label_pos")
    return scores.groupBy(key).agg(
        F.max_by("label", rank).alias("best_label"), F.max("score").alias("best_score")
    )


def identify(
    samples: DataFrame, texts: DataFrame, k: int, labels: Sequence[str], key: str = "doc_id"
) -> DataFrame:
    """Train on ``(label, text)`` samples and name the most likely label of every text."""
    return attribute(train(samples, k, labels), texts, key)
