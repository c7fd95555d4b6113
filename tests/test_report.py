"""The whole analysis with the original profile on a small hand-built survey."""

import itertools
import tempfile

import pytest

from reeflens.plans.profile import REFERENCE as P
from reeflens.plans.report import RESULTS, Analysis, write_results

SURVEY_DDL = ("label string, year int, region string, reef string, depth double, transect int, "
              "protection_level string, latitude double, family string, species string, taxa2 string, "
              "taxa3 string, trophic_level string, size double, biomass double, quantity double, degree double")

REGIONS = {"Santa Rosalia": 27.3, "Loreto": 26.0, "La Paz": 24.2, "Cabo Pulmo": 23.4}
FISH = [("Lutjanus argentiventris", "Lutjanidae", "3.5"), ("Abudefduf troschelii", "Pomacentridae", "2.8"),
        ("Scarus ghobban", "Scaridae", "2.0")]
INV = [("Muricea californica", "Anthozoa", "Holaxonia"), ("Pocillopora verrucosa", "Anthozoa", "Scleractinia"),
       ("Phataria unifascialis", "Asteroidea", "Valvatida"), ("Diadema mexicanum", "Echinoidea", "Diadematoida")]


def _survey(spark):
    rows = []
    for (region, lat), year, reef, transect in itertools.product(
            REGIONS.items(), (2012, 2016, 2025), ("r1", "r2"), (1, 2)):
        if reef == "r2" and year == 2025:
            continue
        for i, (sp, fam, tl) in enumerate(FISH):
            size = 10.0 + i + transect
            rows.append(("PEC", year, region, reef, 5.0, transect, "Prohibited" if reef == "r1" else "Open Area",
                         lat, fam, sp, None, None, tl, size, 0.5 + i * 0.25 + transect * 0.1, 3.0 + i, None))
        for j, (sp, t2, t3) in enumerate(INV):
            rows.append(("INV", year, region, reef, 5.0, transect, "Allowed", lat, None, sp, t2, t3, None, None,
                         None, float(j + transect), None))
    return spark.createDataFrame(rows, SURVEY_DDL)


@pytest.fixture(scope="module")
def analysis(spark):
    comm = spark.createDataFrame([(s, "yes" if i % 2 == 0 else "no") for i, (s, _, _) in enumerate(FISH)],
                                 "species string, commercial string")
    traits = spark.createDataFrame([("Lutjanus argentiventris", 3.5, "GenPred_solitary"),
                                    ("Abudefduf troschelii", 2.8, "Plank"),
                                    ("Scarus ghobban", 2.0, "EpiBent_schooling")],
                                   "species string, trophic_level double, functional_name string")
    lats = spark.createDataFrame(list(REGIONS.items()), "region string, lat double")
    return Analysis(_survey(spark), comm, traits, lats, P)


def test_every_result_builds_with_the_reference_profile(analysis):
    counts = {name: build(analysis).count() for name, build in RESULTS.items()}
    assert counts["fish_productivity"] > 0
    assert counts["biomass_by_region"] > 0 and counts["coral_by_region"] > 0
    assert counts["top_fish_north_3p"] > 0 and counts["top_inv_south"] > 0
    assert counts["shannon_by_transect"] > 0


def test_reference_labels_flow_through(analysis):
    prot = {r["protection_level"] for r in RESULTS["biomass_by_protection"](analysis).collect()}
    assert prot <= {"Sin Pesca", "Multi-uso", "Sin Protección"} and "Sin Pesca" in prot
    periods = {r["period"] for r in RESULTS["fish_species_reef"](analysis).collect()}
    assert periods == {"Histórico (1998-2013)", "Calentamiento (2014-2024)", "2025"}
    top = RESULTS["top_inv_north"](analysis).collect()
    assert {r["species"] for r in top} & {"Muricea sp", "Pocillopora sp"}
    hist = {r["category"] for r in RESULTS["richness_history"](analysis).collect()}
    assert hist == {"Histórico", "2025"}


def test_write_results(spark, analysis):
    out = tempfile.mkdtemp(prefix="reeflens-report-")
    paths = write_results(analysis, out, ["biomass_by_region", "chart_top_inv"])
    assert spark.read.parquet(paths["biomass_by_region"]).count() == \
        RESULTS["biomass_by_region"](analysis).count()


def test_command_line_run(spark):
    import os

    from reeflens.__main__ import main
    base = tempfile.mkdtemp(prefix="reeflens-cli-")
    raw = _survey(spark).drop("degree")
    raw = raw.toDF(*[c.title() if c != "protection_level" else "Protection_Level" for c in raw.columns])
    from pyspark.sql import functions as F
    raw = raw.select(F.monotonically_increasing_id().alias("Row"), *raw.columns)
    raw.filter(F.col("Year") < 2020).write.parquet(os.path.join(base, "historic"))
    raw.filter(F.col("Year") >= 2020).write.parquet(os.path.join(base, "current"))
    spark.createDataFrame([(s, "yes") for s, _, _ in FISH], "Species string, Commercial string") \
         .write.parquet(os.path.join(base, "comm"))
    spark.createDataFrame([(s, float(t), "Plank") for s, _, t in FISH],
                          "Species string, TrophicLevel double, functional_name string") \
         .write.parquet(os.path.join(base, "traits"))
    spark.createDataFrame(list(REGIONS.items()), "Region string, Lat double").write.parquet(os.path.join(base, "lats"))
    out = os.path.join(base, "out")
    paths = main(["--historic", os.path.join(base, "historic"), "--current", os.path.join(base, "current"),
                  "--comm-sp", os.path.join(base, "comm"), "--traits", os.path.join(base, "traits"),
                  "--lats", os.path.join(base, "lats"), "--out", out,
                  "--results", "fish_productivity,biomass_by_region,top_fish_north_3p"])
    fishp = spark.read.parquet(paths["fish_productivity"])
    assert "commercial" in fishp.columns and "functional_name" in fishp.columns
    assert fishp.filter(F.col("functional_name") == "Plank").count() > 0
    assert spark.read.parquet(paths["biomass_by_region"]).count() > 0
