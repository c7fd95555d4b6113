"""Fish pipelines: screening, biomass trends, functional groups, top-10 species.

Each function takes DataFrames and a :class:`Profile` and returns a lazy
(Q1-Q13).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import commercial_label, lat_band, period_label, with_factor
from ..functions.semantics import in_set, mean_na, not_in_set, to_double
from ..operators.joins import natural_left_join
from ..operators.outliers import drop_flagged, drop_rule_outliers, size_check
from ..operators.ranking import reorder_within, top_n_with_share
from ..operators.sites import SiteSelection, consistent_sites
from ..operators.trends import mixed_grain, reef_mean, transect_sum, trend_summary
from ..operators.unions import union_fill
from .profile import Profile


def fish_productivity(survey: DataFrame, comm_sp: DataFrame, group_traits: DataFrame,
                      p: Profile) -> DataFrame:
    """Q1 (D15): fish records, lookups attached, outliers screened."""
    df = (survey.filter(F.col("label") == F.lit(p.fish_label))
                .withColumn("trophic_level", to_double("trophic_level")))
    df = natural_left_join(df, comm_sp)
    df = natural_left_join(df, group_traits)
    df = (df.withColumn("commercial", commercial_label("commercial", p.commercial_yes,
                                                       *p.commercial_labels))
            .filter(in_set("region", p.regions)))
    df = drop_rule_outliers(df, p.set_rules, p.year_rules, "biomass")
    return drop_flagged(size_check(df))


def biomass_raw(fish: DataFrame, p: Profile) -> DataFrame:
    """Q2 (D4): reef-grain biomass, transect grain for one region."""
    return mixed_grain(fish, "biomass", p.transect_grain_region)


def biomass_raw_union(fish: DataFrame, p: Profile) -> DataFrame:
    """Q2 as the analysis writes it (U2): two tables of their own grain, bound together by name.

    ``depth`` and ``transect`` are columns of the second table only and NULL in
    the rows of the first.  :func:`biomass_raw` gives the same rows from one scan.
    """
    one = F.col("region") == F.lit(p.transect_grain_region)
    return union_fill(reef_mean(fish.filter(~one), "biomass", strict=True), transect_sum(fish.filter(one), "biomass", strict=True))


def balanced_biomass(fish: DataFrame, p: Profile) -> SiteSelection:
    """Q3 (D2) over Q2."""
    return consistent_sites(biomass_raw(fish, p))


def biomass_by_region(balanced: DataFrame) -> DataFrame:
    """Q4: mean, sd, n and se of biomass per (year, region)."""
    return trend_summary(balanced, "biomass", ["year", "region"], with_sd_n=True)


def biomass_by_protection(balanced: DataFrame, p: Profile) -> DataFrame:
    """Q5: mean and se per (year, protection level), level recoded to its label."""
    s = trend_summary(balanced, "biomass", ["year", "protection_level"])
    return with_factor(s, "protection_level", p.protection_levels, p.protection_labels)


def biomass_functional_reef(fish: DataFrame) -> SiteSelection:
    """Q6: strict reef biomass per functional group over consistent sites."""
    return consistent_sites(reef_mean(fish, "biomass", ["functional_name"], strict=True))


def biomass_by_functional(balanced_f: DataFrame, p: Profile) -> DataFrame:
    """Q7: trend per (year, region, protection, functional group)."""
    s = trend_summary(balanced_f, "biomass", ["year", "region", "protection_level", "functional_name"])
    return with_factor(s, "protection_level", p.protection_levels, p.protection_labels)


def fish_species_selection(fish: DataFrame) -> SiteSelection:
    """Reef biomass per (functional group, species) over consistent sites."""
    return consistent_sites(reef_mean(fish, "biomass", ["functional_name", "species"]))


def fish_species_reef(selected: DataFrame, p: Profile, scheme: int = 3) -> DataFrame:
    """Q8: the selection's rows with their period label."""
    return selected.withColumn("period", period_label("year", p.periods(scheme)))


def species_functional(balanced_fish: DataFrame) -> DataFrame:
    """Q9: distinct (species, functional group) pairs."""
    return balanced_fish.select("species", "functional_name").distinct()


def top_fish(balanced_fish: DataFrame, functional_lookup: DataFrame, lats: DataFrame, p: Profile,
             band: str, scheme: int = 3) -> DataFrame:
    """Q10-Q13: the rows of one band of :func:`top_fish_bands`."""
    own = p.band_above if band == "north" else p.band_below
    return top_fish_bands(balanced_fish, functional_lookup, lats, p, scheme, (own,)).drop("band")


def top_fish_bands(balanced_fish: DataFrame, functional_lookup: DataFrame, lats: DataFrame, p: Profile,
                   scheme: int = 3, bands: Sequence[str] | None = None) -> DataFrame:
    """D7 + D8 + P19: top-k species by mean biomass per band and period, all bands in one pass.

    Order matters: the share is taken over all species of the period, the
    top-k is taken next, the functional group is re-attached (a species may
    carry several) and only then is the pelagic group removed -- so fewer
    than k species can remain.
    """
    x = natural_left_join(balanced_fish, lats, ["region"])
    x = (x.withColumn("band", lat_band("lat", p.lat_cut, p.band_above, p.band_below))
          .filter(not_in_set("region", p.chart_excluded_regions))
          .filter(F.col("functional_name").isNotNull())
          .filter(F.col("band").isin(*(bands or (p.band_above, p.band_below))))
          .filter(F.col("functional_name") != F.lit(p.pelagic_level)))
    m = x.groupBy("band", "period", "species").agg(mean_na("biomass").alias("biomass"))
    m = with_factor(m, "period", p.period_levels(scheme))
    top = top_n_with_share(m, p.top_k, "biomass", ["band", "period"], "total_biomass", "rel_biomass")
    top = natural_left_join(top, functional_lookup)
    top = with_factor(top, "functional_name", p.functional_levels, p.functional_labels)
    top = top.filter(F.col("functional_name") != F.lit(p.pelagic_label))
    return reorder_within(top, "species", "rel_biomass", "period", "species_key", "species_ord", ["band"])
