"""Diversity pipelines: richness trends and history, Shannon per transect (Q29-Q32)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import history_label, with_factor
from ..functions.semantics import in_set, mean_na
from ..operators.diversity import richness, shannon
from ..operators.joins import natural_left_join
from ..operators.ranking import order_by_mean
from ..operators.sites import SiteSelection, consistent_sites
from ..operators.trends import trend_summary
from .profile import Profile


def richness_reef(survey: DataFrame, p: Profile) -> SiteSelection:
    """Q29 (F6, D12, D2): richness of echinoderms, corals and fish, consistent sites.

    Runs on the unscreened survey and every region.
    """
    keep = (in_set("taxa2", p.echinoderm_taxa2) | in_set("taxa3", p.coral_taxa3)
            | (F.col("label") == F.lit(p.fish_label)))
    return consistent_sites(richness(survey.filter(keep), ["label"]))


def richness_by_region(balanced: DataFrame) -> DataFrame:
    """Q30: trend of richness per (year, region, label)."""
    return trend_summary(balanced, "richness", ["year", "region", "label"])


def richness_history(by_region: DataFrame, lats: DataFrame, p: Profile) -> DataFrame:
    """Q31 (D17, A15): invertebrate richness, history against the current year.

    The mean of the yearly means is unweighted (A15).
    """
    x = (by_region.filter(in_set("region", p.richness_regions))
                  .withColumn("category", history_label("year", p.current_year, p.history_label,
                                                        p.current_label)))
    x = with_factor(x, "category", (p.history_label, p.current_label))
    m = (x.groupBy("category", "category_ord", "region", "label")
          .agg(mean_na("mean_richness").alias("richness"))
          .filter(F.col("label") == F.lit(p.inv_label)))
    m = natural_left_join(m, lats, ["region"])
    return order_by_mean(m, "region", "richness", "region_ord")


def shannon_by_transect(survey: DataFrame, numeric_transect: bool = False) -> DataFrame:
    """Q32 (D10): Shannon index per (region, reef, transect) over every label and year.

    ``numeric_transect`` takes the unit's numeric columns into the matrix, chosen
    from the schema (P4), as the analysis does.
    """
    return shannon(survey, ("region", "reef", "transect"), numeric_unit_cols="auto" if numeric_transect else ())
