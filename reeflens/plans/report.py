"""The whole analysis: every named result and chart table, and their sink.

``Analysis`` holds the inputs (combined survey, the three lookups, a
profile) and holds the shared stems: the screened fish table, the
invertebrate subset and the selected fish species are stored as Parquet in
the session's shared folder on first use, so every result reads them instead
of computing them again.  Building a result therefore runs jobs.  ``RESULTS`` maps each result name of
Parquet (replacing the figure files of the original analysis).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from ..operators.contrasts import parametric_terms
from ..operators.sites import SiteSelection
from ..operators.smooth import fitted_values, model_summary, smooth_trend
from ..operators.trends import log_scale, with_bounds
from ..store import stored
from . import charts, diversity, fish, invertebrates, smooth
from .profile import Profile


class Analysis:
    """Inputs of the analysis plus memoised shared stems."""

    def __init__(self, survey: DataFrame, comm_sp: DataFrame, group_traits: DataFrame,
                 lats: DataFrame, profile: Profile, fish_stem: DataFrame | None = None):
        self.survey, self.comm_sp, self.group_traits, self.lats = survey, comm_sp, group_traits, lats
        self.p = profile
        self._memo: dict[str, object] = {}
        if fish_stem is not None:
            self._memo["fish"] = fish_stem

    def _get(self, key: str, build: Callable[[], object]):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    @property
    def fish(self) -> DataFrame:
        return self._get("fish", lambda: stored(fish.fish_productivity(
            self.survey, self.comm_sp, self.group_traits, self.p), "fish"))

    @property
    def inv(self) -> DataFrame:
        return self._get("inv", lambda: stored(
            invertebrates.invertebrates(self.survey, self.p), "invertebrates"))

    @property
    def biomass_sel(self) -> SiteSelection:
        return self._get("biomass_sel", lambda: fish.balanced_biomass(self.fish, self.p))

    @property
    def functional_sel(self) -> SiteSelection:
        return self._get("functional_sel", lambda: fish.biomass_functional_reef(self.fish))

    @property
    def species_selection(self) -> DataFrame:
        """The selected species rows, stored once for both period schemes."""
        return self._get("species_sel", lambda: stored(fish.fish_species_selection(self.fish).data, "species"))

    def balanced_fish(self, scheme: int) -> DataFrame:
        return self._get(f"bf{scheme}", lambda: fish.fish_species_reef(self.species_selection, self.p, scheme))

    @property
    def functional_lookup(self) -> DataFrame:
        return self._get("sfun", lambda: fish.species_functional(self.balanced_fish(3)))

    @property
    def coral_sel(self) -> SiteSelection:
        return self._get("coral_sel", lambda: invertebrates.balanced_coral(self.inv, self.p))

    @property
    def echinoderm_sel(self) -> SiteSelection:
        return self._get("ech_sel", lambda: invertebrates.echinoderm_reef(self.inv, self.p))

    @property
    def inv_by_region(self) -> DataFrame:
        return self._get("ibr", lambda: invertebrates.invertebrates_by_region(self.inv, self.p))

    @property
    def balanced_inv(self) -> DataFrame:
        return self._get("binv", lambda: invertebrates.inv_species_reef(self.inv, self.p))

    @property
    def richness_sel(self) -> SiteSelection:
        return self._get("rich_sel", lambda: diversity.richness_reef(self.survey, self.p))

    # composite results used by several entries
    def biomass_by_region(self) -> DataFrame:
        return fish.biomass_by_region(self.biomass_sel.data)

    def biomass_by_protection(self) -> DataFrame:
        return fish.biomass_by_protection(self.biomass_sel.data, self.p)

    def coral_by_region(self) -> DataFrame:
        return invertebrates.coral_by_region(self.coral_sel.data)

    def coral_by_protection(self) -> DataFrame:
        return invertebrates.coral_by_protection(self.coral_sel.data)

    def coral_trend(self, by: str) -> DataFrame:
        """The yearly coral means that the models fit, by region or protection level, stored once."""
        build = self.coral_by_region if by == "region" else self.coral_by_protection
        return self._get(f"coral_trend_{by}", lambda: stored(build(), "coral_trend"))

    def coral_models(self, by: str, criterion: str = "series") -> DataFrame:
        """The fits of Q19, one row per series, stored once per criterion."""
        return self._get(f"coral_models_{by}_{criterion}", lambda: stored(smooth_trend(
            self.coral_trend(by), "year", "mean_quantity", [CORAL_FACTORS[by], "taxa3"], self.p.gam_k, criterion), "models"))

    def top_fish(self, band: str, scheme: int) -> DataFrame:
        return fish.top_fish(self.balanced_fish(scheme), self.functional_lookup, self.lats, self.p,
                             band, scheme)

    def top_fish_bands(self, scheme: int) -> DataFrame:
        """Both latitude panels of a figure in one table."""
        return fish.top_fish_bands(self.balanced_fish(scheme), self.functional_lookup, self.lats, self.p, scheme)

    def top_inv(self, band: str) -> DataFrame:
        return invertebrates.top_inv(self.balanced_inv, self.lats, self.p, band)

    def richness_by_region(self) -> DataFrame:
        return diversity.richness_by_region(self.richness_sel.data)


#: First factor of the coral models, by their name; the second is ``taxa3``.
CORAL_FACTORS = {"region": "region", "protection": "protection_level"}

_FIT = ("n", "edf", "lambda", "gcv", "r2", "scale", "intercept", "slope", "slope_se", "x_min", "x_max", "coefficients")
_TESTS = ("n", "edf", "f", "ref_df", "p", "r2_adjusted", "r2")


def _models(a: Analysis, by: str, criterion: str, columns: tuple[str, ...]) -> DataFrame:
    return a.coral_models(by, criterion).select(CORAL_FACTORS[by], "taxa3", *columns)


#: Q19 for one factor: ``(analysis, by)`` to the table.
CORAL_RESULTS: dict[str, Callable[[Analysis, str], DataFrame]] = {
    "linear": lambda a, by: smooth.linear_trend(a.coral_trend(by), "year", "mean_quantity", [CORAL_FACTORS[by], "taxa3"]),
    "smooth": lambda a, by: _models(a, by, "series", _FIT),
    "fitted": lambda a, by: fitted_values(
        a.coral_trend(by), a.coral_models(by), "year", [CORAL_FACTORS[by], "taxa3"], a.p.gam_k),
    # what the summary of the fitted model prints
    "tests": lambda a, by: _models(a, by, "series", _TESTS),
    "joint": lambda a, by: _models(a, by, "joint", (*_FIT, "level", "level_se")),
    "joint_tests": lambda a, by: _models(a, by, "joint", _TESTS),
    "joint_terms": lambda a, by: parametric_terms(a.coral_models(by, "joint"), CORAL_FACTORS[by], "taxa3"),
    "joint_summary": lambda a, by: model_summary(a.coral_models(by, "joint")),
}

RESULTS: dict[str, Callable[[Analysis], DataFrame]] = {
    # fish (Q1-Q13)
    "fish_productivity": lambda a: a.fish,
    "biomass_raw": lambda a: fish.biomass_raw(a.fish, a.p),
    "balanced_biomass": lambda a: a.biomass_sel.data,
    "balanced_biomass_site_counts": lambda a: a.biomass_sel.counts,
    "balanced_biomass_selection": lambda a: a.biomass_sel.summary,
    "biomass_by_region": lambda a: a.biomass_by_region(),
    "biomass_by_protection": lambda a: a.biomass_by_protection(),
    "biomass_functional_reef": lambda a: a.functional_sel.data,
    "biomass_by_functional": lambda a: fish.biomass_by_functional(a.functional_sel.data, a.p),
    "fish_species_reef": lambda a: a.balanced_fish(3),
    "species_functional": lambda a: a.functional_lookup,
    "top_fish_north_3p": lambda a: a.top_fish("north", 3),
    "top_fish_south_3p": lambda a: a.top_fish("south", 3),
    "top_fish_north_2p": lambda a: a.top_fish("north", 2),
    "top_fish_south_2p": lambda a: a.top_fish("south", 2),
    # invertebrates (Q14-Q28)
    "invertebrates": lambda a: a.inv,
    "coral_reef": lambda a: invertebrates.coral_reef(a.inv, a.p),
    "balanced_coral": lambda a: a.coral_sel.data,
    "coral_by_region": lambda a: a.coral_by_region(),
    "coral_by_protection": lambda a: a.coral_by_protection(),
    **{f"coral_trend_{by}_{name}": (lambda a, by=by, build=build: build(a, by)) for by in CORAL_FACTORS for name, build in CORAL_RESULTS.items()},
    "echinoderm_reef": lambda a: a.echinoderm_sel.data,
    "echinoderm_by_region": lambda a: invertebrates.echinoderm_by_region(a.echinoderm_sel.data),
    "echinoderm_by_protection": lambda a: invertebrates.echinoderm_by_protection(a.echinoderm_sel.data),
    "invertebrates_by_region": lambda a: a.inv_by_region,
    "inv_bars_absolute": lambda a: invertebrates.inv_bars_absolute(a.inv_by_region, a.lats, a.p),
    "inv_bars_relative": lambda a: invertebrates.inv_bars_relative(a.inv_by_region, a.lats, a.p),
    "inv_species_reef": lambda a: a.balanced_inv,
    "species_taxa": lambda a: invertebrates.species_taxa(a.balanced_inv),
    "top_inv_south": lambda a: a.top_inv("south"),
    "top_inv_north": lambda a: a.top_inv("north"),
    # diversity (Q29-Q32)
    "richness_reef": lambda a: a.richness_sel.data,
    "richness_by_region": lambda a: a.richness_by_region(),
    "richness_history": lambda a: diversity.richness_history(a.richness_by_region(), a.lats, a.p),
    "shannon_by_transect": lambda a: diversity.shannon_by_transect(a.survey),
    # chart tables, the latitude panels of a figure told apart by ``band`` (C1-C9; C8 and C10 are inv_bars_* and richness_history)
    "chart_top_fish_3p": lambda a: a.top_fish_bands(3),
    "chart_top_fish_2p": lambda a: a.top_fish_bands(2),
    "chart_top_inv": lambda a: invertebrates.top_inv_bands(a.balanced_inv, a.lats, a.p),
    "chart_biomass_region": lambda a: charts.biomass_region_chart(a.biomass_by_region(), a.p),
    "chart_biomass_protection": lambda a: charts.biomass_protection_chart(a.biomass_by_protection(), a.p),
    "chart_coral_region": lambda a: charts.region_panel_chart(a.coral_by_region(), a.lats, a.p),
    "chart_coral_protection": lambda a: with_bounds(a.coral_by_protection(), "mean_quantity",
                                                    "se_quantity"),
    "chart_echinoderm_log": lambda a: log_scale(charts.region_panel_chart(
        invertebrates.echinoderm_by_region(a.echinoderm_sel.data), a.lats, a.p, bounds=False)),
}


def write_results(analysis: Analysis, out_dir: str, names: Iterable[str] | None = None) -> dict[str, str]:
    """Build and store each named result as Parquet under ``out_dir``.

    Stems are shared through ``analysis``: the fish screen, each site
    selection and each species table are computed once for all results.
    """
    paths = {}
    for name in (list(names) if names is not None else list(RESULTS)):
        paths[name] = charts.write_chart(RESULTS[name](analysis), out_dir, name)
    return paths
