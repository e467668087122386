"""Mixing sources to target weights by iterative proportional fitting, on DataFrames alone.

Documents are counted into cells (source, language, topic) of tokens, that is words between white
space. The cell weights are raked: in turn each dimension's sums are scaled to its target shares,
until the rounds are done. A document is kept with the probability of its cell, its raked weight
times one common factor over its tokens and at most 1; the factor is calibrated so that the
expected tokens are ``keep_share`` of all where cells allow it. Whether a document stays depends on
a hash of its id and the seed, so every run and every task decides alike.

A target is a map of shares, or an exponent on the observed shares: below 1 it flattens them. In a map,
``"*"`` is the share of all categories it does not name (null ones among them), dealt to them as
they are observed; without it they get none. What the data lack is left out, and the rest is scaled
up. Cells are aggregated and joined as tables; only sums of them reach the driver.

Null categories count as ``unknown``; a null or empty text has no tokens and shares its cell's
fate. Repeated rows are decided alike. Other columns are kept by ``sampled`` and not read by
``rates``. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslink.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 10
CALIBRATIONS = 6


def topic_of(text: Column) -> Column:
    """A coarse topic by form: tables, marked-up noise, long and short prose."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(text.rlike(r"[#$%&*]{3}"), "marked")
        .when(F.length(text) >= 4000, "long")
        .otherwise("prose")
    )


def described(docs: DataFrame, prefix: str = "_") -> DataFrame:
    """``docs`` with its categories and ``n_words``, named with ``prefix``; source and language
    lose their nulls."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns(
        {
            f"{prefix}source": F.coalesce(F.col("source").cast("string"), F.lit("unknown")),
            f"{prefix}lang": F.coalesce(F.col("lang").cast("string"), F.lit("unknown")),
            f"{prefix}topic": topic_of(text),
            f"{prefix}n_words": F.regexp_count(text, F.lit(WORD)).cast("long"),
        }
    )


def raked(cells: DataFrame, targets: dict[str, dict[str, float] | float], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (the dimensions and ``tokens``) with ``weight``: shares of the target mix."""
    cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dim, target in targets.items():
        sums = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("_sum"))
        if isinstance(target, dict):
            named = {name: float(part) for name, part in target.items() if name != "*"}
            others = ~F.col(dim).isin(list(named))
            rest = sums.where(others & (F.col("_sum") > 0)).agg(F.sum("_sum")).first()[0] or 1.0
            share = F.when(others, F.lit(float(target.get("*", 0.0))) * F.col("_sum") / rest)
            for name, part in named.items():
                share = share.when(F.col(dim) == name, part)
            share = share.otherwise(0.0)
        else:
            share = F.when(F.col("_sum") > 0, F.pow("_sum", F.lit(float(target)))).otherwise(0.0)
        shares = cut_lineage(sums.select(dim, F.when(F.col("_sum") > 0, share).otherwise(0.0).alias("_share")))
        total = shares.agg(F.sum("_share")).first()[0] or 1.0
        cells = cells.join(shares, dim).withColumn(f"_{dim}_share", F.col("_share") / total).drop("_share")
    cells = cut_lineage(cells)
    for _ in range(rounds):
        for dim in targets:
            sums = cells.groupBy(dim).agg(F.sum("weight").alias("_sum"))
            scaled = F.when(F.col("_sum") > 0, F.col("weight") * F.col(f"_{dim}_share") / F.col("_sum")).otherwise(0.0)
            cells = cells.join(sums, dim).withColumn("weight", scaled).drop("_sum")
        cells = cut_lineage(cells)
    return cells.drop(*(f"_{dim}_share" for dim in targets))


def calibrated(cells: DataFrame, keep_share: float) -> DataFrame:
    """``cells`` with ``probability``: min(1, factor * weight / tokens). Cells that reach 1 hand the
    rest of the budget on to the others."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    budget, factor = keep_share * total, keep_share * total
    for _ in range(CALIBRATIONS):
        full = F.col("weight") * factor >= F.col("tokens")
        taken, open_ = cells.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not open_:
            break
        factor = max(0.0, budget - taken) / open_
    return cells.withColumn(
        "probability",
        F.when(F.col("tokens") > 0, F.least(F.lit(1.0), factor * F.col("weight") / F.col("tokens"))).otherwise(
            F.lit(float(keep_share))
        ),
    )


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(
    docs: DataFrame, targets: dict[str, dict[str, float] | float], keep_share: float, seed: int = 0
) -> DataFrame:
    """Per row ``doc_id``, its categories, ``n_words``, ``probability`` and whether it is ``kept``."""
    docs = docs.select("doc_id", "text", "source", "lang")
    named = {f"_{dim}": dim for dim in (*DIMENSIONS, "n_words")}
    seen = cut_lineage(described(docs).select("doc_id", *named).withColumnsRenamed(named))
    cells = seen.groupBy(*DIMENSIONS).agg(F.sum("n_words").alias("tokens"))
    cells = calibrated(cut_lineage(raked(cut_lineage(cells), targets)), keep_share)
    return (
        seen.join(cells.select(*DIMENSIONS, "probability"), list(DIMENSIONS))
        .withColumn("kept", draw(F.col("doc_id"), seed) < F.col("probability"))
        .select("doc_id", *DIMENSIONS, "n_words", "probability", "kept")
    )


def sampled(
    docs: DataFrame, targets: dict[str, dict[str, float] | float], keep_share: float, seed: int = 0
) -> DataFrame:
    """The kept rows of ``docs`` with all their columns."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    full = described(docs, prefix)
    cells = full.groupBy(*(F.col(prefix + d).alias(d) for d in DIMENSIONS)).agg(F.sum(f"{prefix}n_words").alias("tokens"))
    cells = calibrated(cut_lineage(raked(cut_lineage(cells), targets)), keep_share)
    chance = f"{prefix}probability"
    own = cells.select(*(F.col(d).alias(prefix + d) for d in DIMENSIONS), F.col("probability").alias(chance))
    return (
        full.join(own, [prefix + d for d in DIMENSIONS])
        .where(draw(F.col("doc_id"), seed) < F.col(chance))
        .select(*docs.columns)
    )
