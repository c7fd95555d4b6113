"""Parameters of the survey analysis.

Every literal the pipelines depend on -- label codes, region lists, outlier
rules, period cut-offs, factor levels and their display labels -- lives in a
``Profile``.  ``REFERENCE`` holds the values of the original analysis;
``sources.driver_tables.OBSERVATION`` maps the same roles onto the
TPC-H-shaped test tables so the identical pipelines can be checked there.
"""

from __future__ import annotations

from dataclasses import dataclass

from ..operators.outliers import SetRule, YearRule

Cut = tuple[int | None, int | None, str]


@dataclass(frozen=True)
class Profile:
    fish_label: str
    inv_label: str
    regions: tuple[str, ...]
    set_rules: tuple[SetRule, ...]
    year_rules: tuple[YearRule, ...]
    transect_grain_region: str
    chart_excluded_regions: tuple[str, ...]
    protection_levels: tuple[str, ...]
    protection_labels: tuple[str, ...]
    functional_levels: tuple[str, ...]
    functional_labels: tuple[str, ...]
    pelagic_level: str
    pelagic_label: str
    periods3: tuple[Cut, ...]
    periods2: tuple[Cut, ...]
    lat_cut: float
    band_above: str
    band_below: str
    coral_taxa3: tuple[str, ...]
    echinoderm_taxa2: tuple[str, ...]
    collapse_early: tuple[str, str]
    collapse_late: tuple[str, str]
    region_order: tuple[str, ...]
    richness_regions: tuple[str, ...]
    current_year: int
    history_label: str
    current_label: str
    commercial_yes: str = "yes"
    commercial_labels: tuple[str, str] = ("Commercial", "No commercial")
    historic_excluded_families: tuple[str, ...] = ()
    top_k: int = 10
    reference_line: float = 4.0
    gam_k: int = 10

    def period_levels(self, scheme: int) -> tuple[str, ...]:
        return tuple(c[2] for c in (self.periods3 if scheme == 3 else self.periods2))

    def periods(self, scheme: int) -> tuple[Cut, ...]:
        return self.periods3 if scheme == 3 else self.periods2


# These must equal the original analysis for identical results.
REFERENCE = Profile(
    fish_label="PEC",
    inv_label="INV",
    regions=("Cabo Pulmo", "Corredor", "La Paz", "La Ventana", "Loreto", "San Basilio",
             "Santa Rosalia"),
    set_rules=(SetRule(regions=("Corredor", "Santa Rosalia"), families=("Haemulidae", "Carangidae"),
                       limit=3.0),),
    year_rules=(YearRule(region="Santa Rosalia", year=2022, limit=2.5),),
    transect_grain_region="Santa Rosalia",
    chart_excluded_regions=("Cabo Pulmo", "La Ventana"),
    protection_levels=("Prohibited", "Allowed", "Open Area"),
    protection_labels=("Sin Pesca", "Multi-uso", "Sin Protección"),
    functional_levels=("GenPred_solitary", "GenPred_schooling", "EpiBent_schooling",
                       "Crip_schooling", "Crip_solitary", "Plank", "Pelagic"),
    functional_labels=("Depredadores solitarios", "Depredadores en cardúmenes",
                       "Omnívoros en cardúmen", "Herbívoros en cardúmen", "Crípticos solitarios",
                       "Planctívoros", "Pelágicos"),
    pelagic_level="Pelagic",
    pelagic_label="Pelágicos",
    periods3=((None, 2013, "Histórico (1998-2013)"), (2014, 2024, "Calentamiento (2014-2024)"),
              (2025, 2025, "2025")),
    periods2=((None, 2024, "Histórico (1998-2024)"), (2025, 2025, "2025")),
    lat_cut=26.0,
    band_above="Arriba de 26°",
    band_below="Debajo de 26°",
    coral_taxa3=("Holaxonia", "Scleractinia"),
    echinoderm_taxa2=("Asteroidea", "Echinoidea"),
    collapse_early=("Muricea", "Muricea sp"),
    collapse_late=("Pocillopora", "Pocillopora sp"),
    region_order=("Santa Rosalia", "San Basilio", "Loreto", "Corredor", "La Paz", "La Ventana",
                  "Cabo Pulmo"),
    richness_regions=("Corredor", "La Paz", "Loreto", "San Basilio", "Santa Rosalia"),
    current_year=2025,
    history_label="Histórico",
    current_label="2025",
    historic_excluded_families=("Carangidae",),
)
