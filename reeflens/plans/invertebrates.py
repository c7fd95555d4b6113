"""Invertebrate pipelines: corals, echinoderms, taxon bars, top-10 species (Q14-Q28)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import collapse_species, lat_band, period_label, taxon_label, with_factor
from ..functions.semantics import in_set, mean_na, not_in_set
from ..operators.joins import natural_left_join
from ..operators.ranking import (fill_share, order_by_mean, reorder_within, stack_extents,
                                 top_n_ties)
from ..operators.sites import SiteSelection, consistent_sites
from ..operators.trends import reef_mean, trend_summary
from .profile import Profile


def invertebrates(survey: DataFrame, p: Profile) -> DataFrame:
    """Q14: invertebrate records of the monitored regions (no size screen)."""
    return survey.filter(F.col("label") == F.lit(p.inv_label)).filter(in_set("region", p.regions))


def coral_reef(inv: DataFrame, p: Profile) -> DataFrame:
    """Q15: reef-mean quantity per coral order (taxa3)."""
    return reef_mean(inv.filter(in_set("taxa3", p.coral_taxa3)), "quantity", ["taxa3"])


def balanced_coral(inv: DataFrame, p: Profile) -> SiteSelection:
    """Q16 (D2) over Q15."""
    return consistent_sites(coral_reef(inv, p))


def coral_by_region(balanced: DataFrame) -> DataFrame:
    """Q17."""
    return trend_summary(balanced, "quantity", ["year", "region", "taxa3"])


def coral_by_protection(balanced: DataFrame) -> DataFrame:
    """Q18."""
    return trend_summary(balanced, "quantity", ["year", "protection_level", "taxa3"])


def echinoderm_reef(inv: DataFrame, p: Profile) -> SiteSelection:
    """Q20: reef-mean quantity per echinoderm class (taxa2), consistent sites."""
    return consistent_sites(
        reef_mean(inv.filter(in_set("taxa2", p.echinoderm_taxa2)), "quantity", ["taxa2"]))


def echinoderm_by_region(balanced: DataFrame) -> DataFrame:
    """Q21."""
    return trend_summary(balanced, "quantity", ["year", "region", "taxa2"])


def echinoderm_by_protection(balanced: DataFrame) -> DataFrame:
    """Q22."""
    return trend_summary(balanced, "quantity", ["year", "protection_level", "taxa2"])


def _with_taxa(inv: DataFrame, p: Profile) -> DataFrame:
    keep = list(p.coral_taxa3) + list(p.echinoderm_taxa2)
    return (inv.withColumn("taxa", taxon_label("taxa3", "taxa2", p.coral_taxa3, p.echinoderm_taxa2))
               .filter(in_set("taxa", keep)))


def invertebrates_by_region(inv: DataFrame, p: Profile) -> DataFrame:
    """Q23 (D13, D3, D2, D5): trend per (year, region, taxon)."""
    sel = consistent_sites(reef_mean(_with_taxa(inv, p), "quantity", ["taxa"]))
    return trend_summary(sel.data, "quantity", ["year", "region", "taxa"])


def inv_bars_absolute(by_region: DataFrame, lats: DataFrame, p: Profile) -> DataFrame:
    """Q24: current-year stacked bars; regions ordered by descending latitude."""
    x = natural_left_join(by_region.filter(F.col("year") == F.lit(p.current_year)), lats, ["region"])
    x = order_by_mean(x, "region", -F.col("lat"), "region_ord")
    return stack_extents(x, "mean_quantity", ["region"], "taxa")


def inv_bars_relative(by_region: DataFrame, lats: DataFrame, p: Profile) -> DataFrame:
    """Q25: the same bars filled to 100 % per region."""
    x = natural_left_join(by_region.filter(F.col("year") == F.lit(p.current_year)), lats, ["region"])
    x = order_by_mean(x, "region", -F.col("lat"), "region_ord")
    return fill_share(x, "mean_quantity", ["region"], "share")


def inv_species_reef(inv: DataFrame, p: Profile) -> DataFrame:
    """Q26: reef-mean quantity per (taxon, species), consistent sites, three periods."""
    pat, lab = p.collapse_early
    x = _with_taxa(inv, p).withColumn("species", collapse_species("species", pat, lab, na_aware=False))
    sel = consistent_sites(reef_mean(x, "quantity", ["taxa", "species"]))
    return sel.data.withColumn("period", period_label("year", p.periods3))


def species_taxa(balanced_inv: DataFrame) -> DataFrame:
    """Q26 lookup: distinct (taxa, species)."""
    return balanced_inv.select("taxa", "species").distinct()


def top_inv(balanced_inv: DataFrame, lats: DataFrame, p: Profile, band: str) -> DataFrame:
    """Q27/Q28: the rows of one band of :func:`top_inv_bands`."""
    return top_inv_bands(balanced_inv, lats, p, (p.band_above if band == "north" else p.band_below,)).drop("band")


def top_inv_bands(balanced_inv: DataFrame, lats: DataFrame, p: Profile, bands: Sequence[str] | None = None) -> DataFrame:
    """Top-k species by mean quantity per band and period, all bands in one pass."""
    pat, lab = p.collapse_late
    x = natural_left_join(balanced_inv, lats, ["region"])
    x = (x.withColumn("band", lat_band("lat", p.lat_cut, p.band_above, p.band_below))
          .filter(not_in_set("region", p.chart_excluded_regions) & F.col("band").isin(*(bands or (p.band_above, p.band_below)))))
    x = with_factor(x, "period", p.period_levels(3))
    x = x.withColumn("species", collapse_species("species", pat, lab, na_aware=True))
    m = (x.groupBy("band", "period", "period_ord", "taxa", "species")
          .agg(mean_na("quantity").alias("quantity")))
    top = top_n_ties(m, p.top_k, "quantity", ["band", "period"])
    return reorder_within(top, "species", "quantity", "period", "species_key", "species_ord", ["band"])
