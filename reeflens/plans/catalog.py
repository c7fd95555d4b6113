"""Registry of named results over the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the survey view of :mod:`reeflens.sources.driver_tables` with the
``OBSERVATION`` profile.  Double columns are rounded to 6 decimals at the
very end so that results can be compared across engines whose floating sums
run in a different order; the library functions themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from ..operators.outliers import drop_flagged, size_check
from ..operators.sites import consistent_sites
from ..operators.unions import pivot_wider
from ..sources import driver_tables as dt
from ..sources.survey import load_export, load_traits
from ..store import new_path
from .diversity import shannon_by_transect
from .fish import biomass_raw, biomass_raw_union
from .profile import Profile
from .report import RESULTS, Analysis

P: Profile = dt.OBSERVATION


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column and array (presentation for cross-engine comparison)."""
    def shown(f):
        if isinstance(f.dataType, (DoubleType, FloatType)):
            return F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, DoubleType):
            return F.transform(f.name, lambda v: F.round(v, digits)).alias(f.name)
        return F.col(f.name)
    return df.select(*[shown(f) for f in df.schema.fields])


def analysis(spark: SparkSession, sf_dir: str, survey: DataFrame | None = None,
             fish_stem: DataFrame | None = None) -> Analysis:
    """The analysis over the test tables (survey view and lookups built lazily)."""
    return Analysis(survey if survey is not None else dt.survey_view(spark, sf_dir),
                    dt.commercial_lookup(spark, sf_dir), dt.trait_lookup(spark, sf_dir),
                    dt.latitude_lookup(spark, sf_dir), P, fish_stem)


def _q(name: str) -> Callable[..., DataFrame]:
    build = RESULTS[name]

    def run(spark: SparkSession, sf_dir: str, survey: DataFrame | None = None,
            fish_stem: DataFrame | None = None) -> DataFrame:
        # the figures of a penalised fit have fewer digits that do not depend on the solver
        return rounded(build(analysis(spark, sf_dir, survey, fish_stem)), 4 if name.startswith("coral_trend") and not name.endswith(("_linear", "_fitted")) else 6)
    run.uses_survey = True
    return run


def _events_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "value")
    return rounded(drop_flagged(size_check(ev, "value", ["event_type"])))


def _events_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "value")
    flagged = size_check(ev, "value", ["event_type"])
    return rounded(flagged.groupBy("event_type", "q1", "q3", "lower_bound", "upper_bound").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("size_flagged_outlier").cast("int")).alias("n_flagged")))


def _on_analysis(build: Callable[[Analysis], DataFrame]) -> Callable[..., DataFrame]:
    def run(spark: SparkSession, sf_dir: str, survey: DataFrame | None = None,
            fish_stem: DataFrame | None = None) -> DataFrame:
        return rounded(build(analysis(spark, sf_dir, survey, fish_stem)))
    run.uses_survey = True
    return run


def _wide(a: Analysis) -> DataFrame:
    """Summed quantities with one column per taxon of the table."""
    keys = ["region", "protection_level"]
    sums = a.survey.groupBy(*keys, "taxa2").agg(F.sum("quantity").alias("quantity"))
    return pivot_wider(sums, keys, "taxa2", "quantity", fill=0.0)


def _traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed reader over a CSV file with missing and malformed cells."""
    path = new_path(spark, "traits") + ".csv"
    dt.trait_export(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return rounded(load_traits(spark, path))


def _sargassum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: a third export through its reader."""
    path = new_path(spark, "sargassum")
    dt.survey_exports(spark, sf_dir)[0].write.parquet(path)
    return rounded(load_export(spark, path))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # D1 alone, on a table with real outliers
    "size_outliers_events": _events_outliers,
    "size_flags_events": _events_flags,
    # operators that no named result shows by themselves
    "survey_combined": _on_analysis(lambda a: a.survey),
    "biomass_site_coverage": _on_analysis(lambda a: a.biomass_sel.sites),
    "balanced_biomass_min_years": _on_analysis(lambda a: consistent_sites(biomass_raw(a.fish, a.p), min_years=3).data),
    "shannon_by_transect_matrix": _on_analysis(lambda a: shannon_by_transect(a.survey, numeric_transect=True)),
    "quantity_by_taxa_wide": _on_analysis(_wide),
    "biomass_raw_union": _on_analysis(lambda a: biomass_raw_union(a.fish, a.p)),
    "biomass_site_report": _on_analysis(lambda a: a.biomass_sel.ranked()),
    # sources read from files
    "traits_csv": _traits,
    "sargassum_export": _sargassum,
    # every named result and chart table of the analysis
    **{name: _q(name) for name in RESULTS},
}
