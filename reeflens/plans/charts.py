"""Chart tables (C1-C10) and their sink.

The analysis ends in figures; here every figure is delivered as the table a
plotting tool needs: values, error-bar extents, facet and label orderings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import with_factor
from ..functions.semantics import not_in_set
from ..operators.joins import natural_left_join
from ..operators.trends import with_bounds
from .profile import Profile


def biomass_region_chart(by_region: DataFrame, p: Profile) -> DataFrame:
    """Biomass trend per region without the excluded regions, with bounds."""
    x = with_bounds(by_region.filter(not_in_set("region", p.chart_excluded_regions)),
                    "mean_biomass", "se_biomass")
    return x.withColumn("reference_line", F.lit(p.reference_line))


def biomass_protection_chart(by_protection: DataFrame, p: Profile) -> DataFrame:
    """Biomass trend per protection level, with bounds."""
    return (with_bounds(by_protection, "mean_biomass", "se_biomass")
            .withColumn("reference_line", F.lit(p.reference_line)))


def region_panel_chart(by_region: DataFrame, lats: DataFrame, p: Profile,
                       bounds: bool = True) -> DataFrame:
    """One facet per region, north to south; excluded regions removed.

    The region is first recoded to the ordered level list (an unknown region
    becomes NULL) and the exclusion keeps NULL, as in the analysis.
    """
    x = natural_left_join(by_region, lats, ["region"])
    x = with_factor(x, "region", p.region_order)
    x = x.filter(not_in_set("region", p.chart_excluded_regions))
    return with_bounds(x, "mean_quantity", "se_quantity") if bounds else x


def write_chart(df: DataFrame, out_dir: str, name: str) -> str:
    """Store one chart table as Parquet (replaces ``ggsave``)."""
    path = f"{out_dir.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path
