"""Consistently monitored sites.

A site is (region, reef).  Over the whole input:

1. ``total`` = number of distinct years (a NULL year counts as one value);
2. per site, ``years_monitored`` = distinct years and ``coverage`` =
   ``years_monitored / total``;
3. unless a threshold is given: the best coverage of each region, the worst
   of those, and ``threshold = ceil(min_max_coverage * total)`` -- computed in
   exactly this floating-point order, because ``ceil((k / n) * n)`` is
   ``k + 1`` for some pairs (e.g. 7/25) and the analysis keeps that result;
4. sites with ``years_monitored >= threshold`` are kept and counted per region;
5. the input rows of kept sites are returned, columns unchanged.

Plan: the input -- an aggregate at reef grain in every pipeline -- is
referenced four times (two scalar subqueries, the site list, the semi join),
so by default it is stored once as Parquet in the shared
``spark.checkpoint.dir``: the upstream scan and aggregations run exactly
once, the readers prune its columns, and the lineage is cut (a lost executor
reads the files again instead of recomputing the fact pipeline).  One ``distinct`` on (site, year) feeds
everything.  ``total`` and the threshold are scalar subqueries
(``DataFrame.scalar()``): Spark runs each once and inlines the value, so no
cross join and no ``collect()`` occurs.  The final step is a null-safe
left-semi join; AQE measures the materialised kept-site list (one row per
site) and turns the join into a broadcast when it is small.  Reusing
``data`` downstream re-runs only the cheap site aggregates over the
stored reef-grain table, never the fact pipeline.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..store import stored
from .joins import _null_safe_join, semi_join_null_safe
from .wide import numbered


@dataclass
class SiteSelection:
    """Result of :func:`consistent_sites`.

    ``data``: input rows of kept sites.  ``sites``: every site with
    ``years_monitored`` and ``coverage``.  ``kept``: kept sites.
    ``counts``: kept sites per region.  ``summary``: one row with
    ``total_years``, ``min_max_coverage`` and ``threshold`` (diagnostics S7).
    """
    data: DataFrame
    sites: DataFrame
    kept: DataFrame
    counts: DataFrame
    summary: DataFrame

    def report(self) -> DataFrame:
        """O1: sites by region, most-monitored first (NULLs last), for printing."""
        return self.sites.orderBy(F.col("region").asc_nulls_last(),
                                  F.col("years_monitored").desc_nulls_last())

    def ranked(self) -> DataFrame:
        """O1 as columns: ``place`` of a site in its region (1 = most years; ties share it), ``region_ord`` of the region.

        Places come from the number of sites per (region, years), so a region
        with many sites is counted in every task, not sorted in one.
        """
        levels = self.sites.groupBy("region", "years_monitored").agg(F.count(F.lit(1)).alias("_n"))
        more = Window.partitionBy("region").orderBy(F.col("years_monitored").desc()).rowsBetween(Window.unboundedPreceding, -1)
        levels = levels.select("region", "years_monitored", (1 + F.coalesce(F.sum("_n").over(more), F.lit(0))).alias("place"))
        regions = numbered(self.sites.select("region").distinct(), "region", "region_ord").withColumn("region_ord", F.col("region_ord") + 1)
        out = _null_safe_join(self.sites, levels, ["region", "years_monitored"], "inner")
        return _null_safe_join(out, regions, ["region"], "inner")


def consistent_sites(df: DataFrame, min_years: int | None = None,
                     site_cols: Sequence[str] = ("region", "reef"), year_col: str = "year",
                     group_col: str = "region", materialize: bool = True) -> SiteSelection:
    site_cols = list(site_cols)
    if materialize:
        df = stored(df, "sites")
    site_years = df.select(*site_cols, year_col).distinct()

    total_df = site_years.select(year_col).distinct().agg(F.count(F.lit(1)).alias("total_years"))
    total = total_df.scalar()

    sites = (site_years.groupBy(*site_cols)
             .agg(F.count(F.lit(1)).alias("years_monitored"))
             .withColumn("coverage", F.col("years_monitored").cast("double") / total.cast("double")))

    if min_years is None:
        min_max = (sites.groupBy(group_col).agg(F.max("coverage").alias("max_coverage"))
                   .agg(F.min("max_coverage").alias("min_max_coverage")))
        threshold = F.ceil(min_max.scalar() * total.cast("double"))
        summary = min_max.select(
            total.alias("total_years"), F.col("min_max_coverage"),
            F.ceil(F.col("min_max_coverage") * total.cast("double")).alias("threshold"))
    else:
        threshold = F.lit(int(min_years)).cast("bigint")
        summary = total_df.select(F.col("total_years"),
                                  F.lit(None).cast("double").alias("min_max_coverage"),
                                  threshold.alias("threshold"))

    kept = sites.filter(F.col("years_monitored") >= threshold)
    counts = kept.groupBy(group_col).agg(F.count(F.lit(1)).alias("site_count"))
    data = semi_join_null_safe(df, kept, site_cols)
    return SiteSelection(data=data, sites=sites, kept=kept, counts=counts, summary=summary)
