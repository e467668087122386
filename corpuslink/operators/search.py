"""Criteria-driven course search.

A :class:`Criteria` says which conditions are active. The plan joins only the tables those
conditions touch, so Catalyst sees plain filters over plain equi joins and pushes both the
predicates and the needed columns down to the scans.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.functions.geo import reach_cells, walking_minutes
from corpuslink.operators.postings import holding_all

SECTION_COLUMNS = ["section_num", "day", "time_start", "time_end"]


@dataclass(frozen=True)
class Criteria:
    """Search conditions; ``None`` means the condition is not active."""

    day: list[str] | None = None
    time_start: int | None = None
    time_end: int | None = None
    building: str | None = None
    walking_time: float | None = None
    enroll_lower: int | None = None
    enroll_upper: int | None = None
    dept: str | None = None
    terms: str | None = None

    @classmethod
    def of(cls, args: "Criteria | Mapping[str, Any]") -> "Criteria":
        if isinstance(args, Criteria):
            found = args
        else:
            unknown = set(args) - {f.name for f in fields(cls)}
            if unknown:
                raise ValueError(f"unknown criteria: {sorted(unknown)}")
            found = cls(**args)
        found._check()
        return found

    def _check(self) -> None:
        if all(getattr(self, f.name) is None for f in fields(self)):
            raise ValueError("at least one criterion is needed")
        if (self.building is None) != (self.walking_time is None):
            raise ValueError("building and walking_time only work together")
        if self.day is not None and not self.day:
            raise ValueError("day needs at least one value")

    @property
    def by_enrollment(self) -> bool:
        return self.enroll_lower is not None or self.enroll_upper is not None

    @property
    def by_section(self) -> bool:
        return self.by_enrollment or any(
            v is not None for v in (self.day, self.time_start, self.time_end, self.building)
        )

    def output_columns(self) -> list[str]:
        """Result columns: they grow with the criteria, each appears once."""
        columns = ["dept", "course_num"]
        if self.by_section:
            columns += SECTION_COLUMNS
        if self.building is not None:
            columns += ["building_code", "walking_time"]
        if self.by_enrollment:
            columns += ["enrollment"]
        if self.dept is not None or self.terms is not None:
            columns += ["title"]
        return columns


def distances_from(gps: DataFrame, building: str) -> DataFrame:
    """Walking minutes from one building to every building of ``gps``.

    The origin enters as a scalar subquery, so no row pairs are formed beyond
    origin rows times buildings and nothing is shuffled.
    """
    origin = (
        gps.where(F.col("building_code") == building)
        .agg(F.collect_list(F.struct(F.col("lon").alias("o_lon"), F.col("lat").alias("o_lat"))))
        .scalar()
    )
    return gps.select("building_code", "lon", "lat", F.inline(origin)).select(
        "building_code",
        walking_minutes(F.col("o_lon"), F.col("o_lat"), F.col("lon"), F.col("lat")).alias("walking_time"),
    )


#: Points per side of a square in which the points of a cell are compared.
REACH_ROWS = 2048


def buildings_within_reach(gps: DataFrame, minutes: float, others: DataFrame | None = None) -> DataFrame:
    """``(from_building, to_building, walking_time)`` for every row of ``gps`` and every row of another
    building of ``others`` (by default of ``gps``) that is at most ``minutes`` away.

    Points meet by an equi join on the cells of a grid as wide as the reach; the exact distance is
    only taken there. A cell with many points is compared in squares of about ``REACH_ROWS`` rows per
    side, dealt over a fixed number of partitions, so no task grows with the densest cell. Rows
    without a place reach nothing."""
    if minutes < 0:
        raise ValueError("minutes must not be negative")
    own, near = reach_cells(F.col("lon"), F.col("lat"), minutes)
    placed = lambda rows: rows.select("building_code", "lon", "lat").where("lon is not null and lat is not null")
    a = placed(gps).select(*[F.col(c).alias(f"{c}_a") for c in ("building_code", "lon", "lat")], F.explode(near).alias("at"))
    b = placed(gps if others is None else others).select("*", own.alias("at"))
    a, b = (side.select("*", "at.*").drop("at") for side in (a, b))
    squares = F.ceil(F.count("*") / REACH_ROWS)
    sizes = (
        a.groupBy("band", "cell").agg(squares.alias("n_rows"))
        .join(b.groupBy("band", "cell").agg(squares.alias("n_columns")), ["band", "cell"])
    )
    spot = lambda names, n: F.pmod(F.xxhash64(*names), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    a = a.join(sizes, ["band", "cell"]).withColumn("row", spot(["building_code_a", "lon_a", "lat_a"], "n_rows"))
    b = b.join(sizes, ["band", "cell"]).withColumn("column", spot(["building_code", "lon", "lat"], "n_columns"))
    a = a.withColumn("column", every("n_columns")).drop("n_rows", "n_columns")
    b = b.withColumn("row", every("n_rows")).drop("n_rows", "n_columns")
    on = ["band", "cell", "row", "column"]
    spark = gps.sparkSession
    # A number of its own keeps the runtime from merging partitions: they are small, their work is not.
    width = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    met = a.repartition(width, *on).join(b.repartition(width, *on), on)
    return (
        met.where("building_code_a <> building_code")
        .withColumn("walking_time", walking_minutes(F.col("lon_a"), F.col("lat_a"), F.col("lon"), F.col("lat")))
        .where(F.col("walking_time") <= minutes)
        .select(F.col("building_code_a").alias("from_building"), F.col("building_code").alias("to_building"), "walking_time")
    )


def building_location(gps: DataFrame, building: str) -> DataFrame:
    """Coordinates of one building; the smallest pair if it is listed more than once."""
    return (
        gps.where(F.col("building_code") == building).select("lon", "lat").orderBy("lon", "lat").limit(1)
    )


def _sections(crit: Criteria, tables: Mapping[str, DataFrame]) -> DataFrame:
    patterns = tables["meeting_patterns"]
    if crit.day is not None:
        patterns = patterns.where(F.col("day").isin(list(crit.day)))
    if crit.time_start is not None:
        patterns = patterns.where(F.col("time_start") >= crit.time_start)
    if crit.time_end is not None:
        patterns = patterns.where(F.col("time_end") <= crit.time_end)
    sections = tables["sections"]
    if crit.enroll_lower is not None:
        sections = sections.where(F.col("enrollment") >= crit.enroll_lower)
    if crit.enroll_upper is not None:
        sections = sections.where(F.col("enrollment") <= crit.enroll_upper)
    if crit.building is not None:
        near = distances_from(tables["gps"], crit.building).where(
            F.col("walking_time") <= crit.walking_time
        )
        sections = sections.join(near, "building_code")
    return sections.join(patterns, "meeting_pattern_id")


def find_courses(
    tables: Mapping[str, DataFrame],
    args: Criteria | Mapping[str, Any],
    match: str = "literal",
    lower_terms: bool = False,
) -> DataFrame:
    """Courses (and sections) that satisfy every active criterion.

    ``tables`` maps courses, sections, meeting_patterns, gps and catalog_index to DataFrames;
    only those the criteria need are read. With several search terms ``match='literal'`` keeps
    a group when its matching index rows number exactly the terms (so a repeated term finds
    nothing); ``match='division'`` asks for every distinct term instead.
    """
    crit = Criteria.of(args)
    if match not in ("literal", "division"):
        raise ValueError("match is 'literal' or 'division'")
    rows = tables["courses"]
    if crit.dept is not None:
        rows = rows.where(F.col("dept") == crit.dept)

    terms: list[str] = []
    if crit.terms is not None:
        terms = (crit.terms.lower() if lower_terms else crit.terms).split(" ")
        hits = tables["catalog_index"].where(F.col("word").isin(sorted(set(terms))))
        if len(terms) == 1:
            rows = rows.join(hits.select("course_id"), "course_id")
        elif match == "division":
            complete = (
                hits.groupBy("course_id")
                .agg(F.count_distinct("word").alias("n"))
                .where(F.col("n") == len(set(terms)))
            )
            rows = rows.join(complete, "course_id", "left_semi")
        else:
            # matching index rows are counted per course before they meet the sections
            n_hits = hits.groupBy("course_id").agg(F.count("*").alias("n_hits"))
            rows = rows.join(n_hits.where(F.col("n_hits") <= len(terms)), "course_id")

    if crit.by_section:
        rows = rows.join(_sections(crit, tables), "course_id")

    columns = crit.output_columns()
    if len(terms) > 1 and match == "literal":
        keys = ["course_id"] + (["section_num"] if crit.by_section else [])
        # of several rows of a group the smallest whole row stands for it
        bare = F.min(F.struct(*[c for c in columns if c not in keys])).alias("_row")
        rows = (
            rows.groupBy(*keys)
            .agg(F.sum("n_hits").alias("n_rows"), bare)
            .where(F.col("n_rows") == len(terms))
            .select(*keys, "_row.*")
        )
    return rows.select(*columns)


def courses_by_postings(courses: DataFrame, chunks: DataFrame, terms: str) -> DataFrame:
    """Courses that hold every distinct word of ``terms`` (split at blanks), found in posting chunks."""
    return courses.join(holding_all(chunks, terms.split(" ")), "course_id", "left_semi").select(
        "dept", "course_num", "title"
    )


def facet(table: DataFrame, column: str, skip: str | None = None) -> DataFrame:
    """Distinct values of one column, without the ``skip`` marker if one is given."""
    values = table.select(column)
    if skip is not None:
        values = values.where(F.col(column) != skip)
    return values.distinct()


def facet_lists(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The three choice lists of the search form: departments, days and buildings."""
    return {
        "dept": facet(tables["courses"], "dept"),
        "day": facet(tables["meeting_patterns"], "day", skip="-1"),
        "building": facet(tables["gps"], "building_code"),
    }


def plain_headers(df: DataFrame) -> DataFrame:
    """Drop a table prefix (up to the first dot) from every column name."""
    return df.toDF(*[c.split(".", 1)[-1] for c in df.columns])
