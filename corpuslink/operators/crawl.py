"""Bounded breadth-first crawl over already fetched pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators.links import followable_links, link_table, page_links, resolved_links
from corpuslink.session import cut_lineage, shared_folder

DEFAULT_BUDGET = 1000
_COMPACT_EVERY = 20
_ROWS_PER_TASK = 10_000


class _Buckets:
    """A table bucketed by one column, so that joins on it do not move its rows. Rows are appended;
    the files lie below the checkpoint folder."""

    def __init__(self, spark: SparkSession, key: str, purpose: str):
        self.spark, self.key, self.purpose = spark, key, purpose
        self.n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name: str | None = None

    def append(self, rows: DataFrame, n_rows: int | None = None) -> None:
        """Add ``rows``; few of them (``n_rows``) are written by few tasks."""
        tasks = self.n if n_rows is None else min(self.n, n_rows // _ROWS_PER_TASK + 1)
        writer = rows.repartition(tasks, self.key).write.bucketBy(self.n, self.key).sortBy(self.key).mode("append")
        if self.name is None:
            folder = shared_folder(self.spark, self.purpose)
            self.name = folder.rpartition("/")[2].replace("-", "_")
            writer = writer.option("path", folder)
        writer.saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def compact(self) -> None:
        """One file per bucket instead of one per bucket and append."""
        held, self.name = self.rows(), None
        self.append(held)


def next_targets(edges: DataFrame, frontier: DataFrame, known: DataFrame) -> DataFrame:
    """``(url, first)``: targets of the frontier that are not known, with their first place. Where
    ``edges`` are bucketed by source and ``known`` by url, only the frontier and its targets move."""
    return (
        edges.join(frontier.select(F.col("url").alias("src"), "visit_no"), "src")
        .groupBy(F.col("dst").alias("url"))
        .agg(F.min(F.struct("visit_no", "pos")).alias("first"))
        .join(known.select("url"), "url", "left_anti")
    )


def crawl_links(
    links: DataFrame,
    start_url: str,
    budget: int = DEFAULT_BUDGET,
    redirects: DataFrame | None = None,
) -> DataFrame:
    """``(url, visit_no, level)`` of the pages a first-in first-out crawl visits.

    ``links`` is ``(src, pos, dst)``; ``redirects`` may give ``(url, final_url)`` so that a page
    reached under another address is not queued again. One Spark job handles one level: new
    targets keep their first place (by parent, then link position) by a combining aggregation,
    known ones drop out by an anti join. Links and known addresses lie in bucketed tables, to which a
    level appends what it found, so what a level shuffles is its frontier and its targets. A level is
    written once, range-partitioned by place, and numbered by its partitions' counts, so a page with
    any number of links spreads over tasks.
    """
    if budget < 1:
        raise ValueError("the budget must be at least 1")
    spark = links.sparkSession
    edges, known = _Buckets(spark, "src", "crawl-links"), _Buckets(spark, "url", "crawl-known")
    edges.append(links.select("src", "pos", "dst"))

    frontier = spark.range(1).select(
        F.lit(start_url).alias("url"), F.col("id").alias("visit_no"), F.lit(0).alias("level")
    )
    used, new, level = 1, 1, 0
    while True:
        reached = frontier
        if redirects is not None:
            finals = redirects.join(frontier.select("url"), "url").select(F.col("final_url").alias("url"))
            reached = frontier.unionByName(finals, allowMissingColumns=True)
        known.append(reached, new)
        visited = known.rows().where("visit_no is not null")
        if used >= budget:
            return visited
        level += 1
        order = ["first.visit_no", "first.pos", "url"]
        placed = cut_lineage(
            next_targets(edges.rows(), frontier, known.rows())
            .repartitionByRange(*order).sortWithinPartitions(*order).select(
                "url", F.monotonically_increasing_id().alias("place")
            )
        )
        # The partition and the row in it are in the place; one count per partition shifts them.
        part, row = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
        shifts, new = [], 0
        for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
            shifts += [F.lit(r["part"]), F.lit(used + new)]
            new += r["n"]
        if new == 0:
            return visited
        numbers = F.element_at(F.create_map(*shifts), part) + row
        frontier = placed.select("url", numbers.cast("long").alias("visit_no"), F.lit(level).alias("level"))
        if used + new > budget:
            frontier = frontier.where(F.col("visit_no") < budget)
        used += new
        if level % _COMPACT_EVERY == 0:
            known.compact()


def crawl_pages(
    pages: DataFrame,
    start_url: str,
    domain: str,
    budget: int = DEFAULT_BUDGET,
    excluded_prefixes: Sequence[str] = (),
) -> DataFrame:
    """Crawl ``(page_id, url, html)`` pages from ``start_url`` inside ``domain``.

    Links are read from each page once, before the first level. A target without a page spends
    budget but leads nowhere. With a ``final_url`` column, links are resolved against it.
    """
    redirects = None
    if "final_url" in pages.columns:
        redirects = pages.where(F.col("final_url") != F.col("url")).select("url", "final_url")
        source = pages.withColumn("asked", F.col("url")).withColumn("url", F.col("final_url"))
        names = pages.select("page_id", F.col("url").alias("asked"))
        links = (
            link_table_by_id(source, domain, excluded_prefixes)
            .join(names, "page_id")
            .select(F.col("asked").alias("src"), "pos", "dst")
        )
    else:
        links = link_table(pages, domain, excluded_prefixes)
    return crawl_links(links, start_url, budget, redirects)


def link_table_by_id(pages: DataFrame, domain: str, excluded_prefixes: Sequence[str] = ()) -> DataFrame:
    """``(page_id, pos, dst)`` of every followable link."""
    found = followable_links(resolved_links(page_links(pages)), domain, excluded_prefixes)
    return found.select("page_id", "pos", F.col("target").alias("dst"))
