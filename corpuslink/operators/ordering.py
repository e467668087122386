"""Places in a global order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.session import cut_lineage

# A place made by Spark: the partition above, the row in it in the lower 33 bits.


def _part() -> Column:
    return F.shiftright("_place", 33)


def _row() -> Column:
    return F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))


def _placed(rows: DataFrame, *order: str | Column) -> DataFrame:
    """``rows`` range-partitioned, sorted inside the partitions and written once, with their place."""
    return cut_lineage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )


def _shift(counts: list) -> Column:
    """For each partition what all before it count. ``counts`` holds (part, n), one per partition."""
    before, entries = 0, []
    for part, n in sorted(map(tuple, counts)):
        entries += [F.lit(part), F.lit(before).cast("long")]
        before += n
    return F.element_at(F.create_map(*entries), _part()) if entries else F.lit(0).cast("long")


def numbered(rows: DataFrame, *order: str | Column, name: str = "pos") -> DataFrame:
    """``rows`` with their 0-based place in the given order.

    Every partition of the sorted rows moves by the number of rows before it; one count per
    partition reaches the driver. The result is read from a written copy."""
    placed = _placed(rows, *order)
    shift = _shift(placed.groupBy(_part().alias("part")).agg(F.count("*")).collect())
    return placed.withColumn(name, _row() + shift).drop("_place")


def numbered_with_bounds(rows: DataFrame, bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with a column ``key``) and ``bounds`` (with ``bound`` of its type) in one order, in one pass.

    Rows get ascending numbers ``pos``; a bound gets the ``pos`` it has among them, which comes
    before an equal key, and ``n_before``, how many rows that is. The windows hold bounds only."""
    given, asked = [c for c in rows.columns if c != "key"], [c for c in bounds.columns if c != "bound"]
    both = _placed(
        rows.select("key", F.lit(1).alias("_kind"), F.struct(*given).alias("_given")).unionByName(
            bounds.select(F.col("bound").alias("key"), F.lit(0).alias("_kind"), F.struct(*asked).alias("_asked")),
            allowMissingColumns=True,
        ),
        "key",
        "_kind",
    )
    counts = both.groupBy(_part().alias("part")).agg(F.count("*").alias("n"), F.sum("_kind").alias("n_rows")).collect()
    pos = _row() + _shift([(r["part"], r["n"]) for r in counts])
    along = Window.partitionBy(_part()).orderBy("_place")
    before = _row() - (F.row_number().over(along) - 1) + _shift([(r["part"], r["n_rows"]) for r in counts])
    placed = both.where("_kind = 0").select("_asked.*", pos.alias("pos"), before.alias("n_before"))
    return both.where("_kind = 1").select("_given.*", pos.alias("pos")), placed


def rank_among(bounds: DataFrame, keys: DataFrame, name: str = "rank") -> DataFrame:
    """``bounds`` (one binary column ``bound``) with the number of ``keys`` (binary column ``key``)
    that are not greater. Both are sorted together; keys are counted along each partition."""
    both = _placed(
        keys.select("key", F.lit(0).alias("_kind")).unionByName(
            bounds.select(F.col("bound").alias("key"), F.lit(1).alias("_kind"))
        ),
        "key",
        "_kind",
    )
    shift = _shift(both.groupBy(_part().alias("part")).agg(F.count_if(F.col("_kind") == 0)).collect())
    along = Window.partitionBy(_part()).orderBy("_place")
    return (
        both.withColumn(name, F.count_if(F.col("_kind") == 0).over(along) + shift)
        .where("_kind = 1")
        .select(F.col("key").alias("bound"), name)
    )
