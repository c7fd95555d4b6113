"""Hand-written fixtures F-1 .. F-9 (FIXTURES.md) with hand-computed results."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from reeflens.functions import labels as L
from reeflens.functions import semantics as S
from reeflens.operators.diversity import richness, shannon
from reeflens.operators.joins import natural_left_join
from reeflens.operators.outliers import drop_flagged, size_check
from reeflens.operators.ranking import reorder_within, top_n_with_share
from reeflens.operators.sites import consistent_sites
from reeflens.operators.trends import reef_mean, trend_summary
from reeflens.operators.unions import union_fill, union_strict
from reeflens.plans.profile import REFERENCE

APPROX = dict(abs=1e-6)


def test_f1_size_check(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 10.0), ("a", None), (None, 5.0), (None, 6.0)],
        "species string, size double")
    out = rows(size_check(df), "species", "size")
    a = [r for r in out if r["species"] == "a"]
    assert a[0]["q1"] == pytest.approx(1.75) and a[0]["q3"] == pytest.approx(4.75)
    assert a[0]["lower_bound"] == pytest.approx(-2.75) and a[0]["upper_bound"] == pytest.approx(9.25)
    flags = {r["size"]: r["size_flagged_outlier"] for r in a}
    assert flags == {1.0: False, 2.0: False, 3.0: False, 10.0: True, None: None}
    n = [r for r in out if r["species"] is None]
    assert n[0]["q1"] == pytest.approx(5.25) and n[0]["q3"] == pytest.approx(5.75)
    assert all(r["size_flagged_outlier"] is False for r in n)
    assert drop_flagged(size_check(df)).count() == 5


def _survey(spark, data, cols="year int, region string, protection_level string, reef string, "
                              "depth double, transect int, biomass double"):
    return spark.createDataFrame(data, cols)


def test_f2_reef_mean_strict_and_skipping(spark, rows):
    df = _survey(spark, [(2020, "A", "P", "r", 5.0, 1, 1.0), (2020, "A", "P", "r", 5.0, 1, None),
                         (2020, "A", "P", "r", 5.0, 2, 2.0), (2020, "A", "P", "r", 5.0, 2, 3.0),
                         (2020, "A", "P", "s", 5.0, 1, None)])
    strict = {r["reef"]: r["biomass"] for r in rows(reef_mean(df, "biomass", strict=True))}
    assert strict["r"] is None and strict["s"] is None
    skip = {r["reef"]: r["biomass"] for r in rows(reef_mean(df, "biomass"))}
    assert skip["r"] == pytest.approx(3.0)
    assert skip["s"] == 0  # all-NULL transect sums to 0


def test_f3_trend_summary(spark, rows):
    df = spark.createDataFrame([("x", 2.0), ("x", 4.0), ("x", None), ("y", 5.0)], "g string, v double")
    out = {r["g"]: r for r in rows(trend_summary(df, "v", ["g"], with_sd_n=True))}
    assert out["x"]["mean_v"] == pytest.approx(3.0)
    assert out["x"]["sd_v"] == pytest.approx(1.414214, **APPROX)
    assert out["x"]["n"] == 3
    assert out["x"]["se_v"] == pytest.approx(0.816497, **APPROX)
    assert out["y"]["mean_v"] == 5.0 and out["y"]["sd_v"] is None and out["y"]["se_v"] is None


def _sites(spark, data):
    return spark.createDataFrame(data, "region string, reef string, year int")


def test_f4_consistent_sites(spark, rows):
    data = ([("A", "a1", y) for y in (2001, 2002, 2003, 2004)] + [("A", "a2", y) for y in (2001, 2002, 2003)]
            + [("A", "a3", 2001)] + [("B", "b1", y) for y in (2001, 2002, 2003)] + [("B", "b2", 2004)])
    sel = consistent_sites(_sites(spark, data))
    assert rows(sel.summary)[0]["threshold"] == 3
    assert sorted({r["reef"] for r in rows(sel.data)}) == ["a1", "a2", "b1"]
    assert sel.data.count() == 10
    assert [(r["region"], r["site_count"]) for r in rows(sel.counts, "region")] == [("A", 2), ("B", 1)]
    sel2 = consistent_sites(_sites(spark, data + [("A", None, y) for y in (2001, 2002, 2003)]))
    assert None in {r["reef"] for r in rows(sel2.data)}


def test_f5_threshold_trap(spark, rows):
    data = [("A", "a", y) for y in range(2000, 2025)] + [("B", "b", y) for y in range(2000, 2007)]
    sel = consistent_sites(_sites(spark, data))
    assert rows(sel.summary)[0]["threshold"] == 8  # ceil((7/25)*25) in floating point
    assert {r["region"] for r in rows(sel.data)} == {"A"}


def test_f5_explicit_threshold(spark, rows):
    data = [("A", "a", y) for y in range(2000, 2025)] + [("B", "b", y) for y in range(2000, 2007)]
    sel = consistent_sites(_sites(spark, data), min_years=7)
    assert {r["region"] for r in rows(sel.data)} == {"A", "B"}


def test_f6_top_k_ties_and_share(spark, rows):
    df = spark.createDataFrame([("p", "s1", 5.0), ("p", "s2", 4.0), ("p", "s3", 4.0), ("p", "s4", 3.0),
                                ("p", "s5", None)], "period string, species string, biomass double")
    out = rows(top_n_with_share(df, 2, "biomass", ["period"], "total", "share"), "species")
    assert [r["species"] for r in out] == ["s1", "s2", "s3"]
    assert [r["share"] for r in out] == pytest.approx([31.25, 25.0, 25.0])


def test_f7_lat_band(spark, rows):
    df = spark.createDataFrame([(24.5,), (25.49,), (25.5,), (26.5,), (None,)], "lat double")
    out = df.select("lat", S.round_half_even("lat").alias("r"),
                    L.lat_band("lat", 26, "north", "south").alias("band")).collect()
    assert [r["r"] for r in out] == [24.0, 25.0, 26.0, 26.0, None]
    assert [r["band"] for r in out] == ["south", "south", "north", "north", None]
    # NULL band is absent from both panels
    assert df.select(L.lat_band("lat", 26, "north", "south").alias("b")).filter(F.col("b") != "north") \
             .filter(F.col("b") != "south").count() == 0


def test_f8_shannon(spark, rows):
    df = spark.createDataFrame(
        [("R", "u", 1, "a", 2.0), ("R", "u", 1, "b", 2.0), ("R", "u", 1, "c", 0.0),
         ("R", "v", 2, "a", 1.0), ("R", "v", 2, "b", 3.0), ("R", "w", 3, "a", 7.0)],
        "region string, reef string, transect int, species string, quantity double")
    h = {r["reef"]: r["shannon_index"] for r in rows(shannon(df))}
    assert h["u"] == pytest.approx(0.693147, **APPROX)
    assert h["v"] == pytest.approx(0.562335, **APPROX)
    assert h["w"] == 0.0
    df4 = df.withColumn("transect", F.when(F.col("reef") == "u", 4).otherwise(F.col("transect")))
    h4 = {r["reef"]: r["shannon_index"] for r in rows(shannon(df4, numeric_unit_cols=("transect",)))}
    assert h4["u"] == pytest.approx(1.039721, **APPROX)
    h5 = {r["reef"]: r["shannon_index"] for r in rows(shannon(df4, numeric_unit_cols="auto"))}
    assert h5 == h4
    ids = {r["transect_id"] for r in rows(shannon(df))}
    assert "R_u_1" in ids


def test_f8_shannon_bounds(spark, rows):
    df = spark.createDataFrame([("R", "u", 1, s, float(q)) for s, q in zip("abcdef", [1, 5, 2, 8, 1, 1])],
                               "region string, reef string, transect int, species string, quantity double")
    h = rows(shannon(df))[0]["shannon_index"]
    assert 0 <= h <= math.log(6)


def test_f9_labels(spark, rows):
    df = spark.createDataFrame([("yes", 2013, "Prohibited"), ("no", 2014, "Other"), (None, 2024, None),
                                ("yes", 2025, "Allowed"), ("no", 2026, "Open Area")],
                               "commercial string, year int, protection_level string")
    out = df.select(
        L.commercial_label("commercial", "yes", "Commercial", "No commercial").alias("c"),
        L.period_label("year", REFERENCE.periods3).alias("p"),
        L.recode("protection_level", REFERENCE.protection_levels, REFERENCE.protection_labels).alias("pl"),
        L.level_order("protection_level", REFERENCE.protection_levels).alias("o")).collect()
    assert [r["c"] for r in out] == ["Commercial", "No commercial", None, "Commercial", "No commercial"]
    assert [r["p"] for r in out] == ["Histórico (1998-2013)", "Calentamiento (2014-2024)",
                                     "Calentamiento (2014-2024)", "2025", None]
    assert [r["pl"] for r in out] == ["Sin Pesca", None, None, "Multi-uso", "Sin Protección"]
    assert [r["o"] for r in out] == [1, None, None, 2, 3]


def test_f9_taxa_membership_cast_share(spark, rows):
    df = spark.createDataFrame([("Holaxonia", "Asteroidea", None, "abc", 1.0, 0.0)],
                               "taxa3 string, taxa2 string, region string, tl string, x double, tot double")
    r = df.select(L.taxon_label("taxa3", "taxa2", REFERENCE.coral_taxa3, REFERENCE.echinoderm_taxa2).alias("t"),
                  S.not_in_set("region", ["Cabo Pulmo"]).alias("keep"),
                  S.to_double("tl").alias("tl"), S.to_double(F.lit("3.5d")).alias("suffix"),
                  (S.safe_div("x", "tot") * 100).alias("share")).collect()[0]
    assert r["t"] == "Holaxonia" and r["keep"] is True and r["tl"] is None and r["suffix"] is None
    assert r["share"] is None


def test_f9_richness_counts_null_once(spark, rows):
    df = spark.createDataFrame([(2020, "A", "P", "r", 5.0, 1, "PEC", s) for s in ("a", "a", None)],
                               "year int, region string, protection_level string, reef string, "
                               "depth double, transect int, label string, species string")
    assert rows(richness(df))[0]["richness"] == 2.0


def test_f9_reorder_within_key(spark, rows):
    df = spark.createDataFrame([("a", None, 1.0), ("b", "p", 2.0), ("c", "p", 1.0)],
                               "species string, period string, v double")
    out = {r["species"]: r for r in rows(reorder_within(df, "species", "v", "period", "k", "o"))}
    assert out["a"]["k"] == "a___NA"
    assert out["c"]["o"] == 1 and out["b"]["o"] == 2


def test_f9_joins(spark, rows):
    x = spark.createDataFrame([("a", 1), (None, 2)], "species string, v int")
    y = spark.createDataFrame([("a", "g1"), ("a", "g2"), (None, "gn")], "species string, g string")
    out = rows(natural_left_join(x, y), "species", "g")
    assert [(r["species"], r["g"]) for r in out] == [("a", "g1"), ("a", "g2"), (None, "gn")]
    with pytest.raises(ValueError):
        natural_left_join(x, spark.createDataFrame([(1,)], "other int"))


def test_f9_unions(spark, rows):
    a = spark.createDataFrame([(1, 2.0)], "year int, biomass double")
    b = spark.createDataFrame([(2, 3.0, 7)], "year int, biomass double, transect int")
    with pytest.raises(AnalysisException):
        union_strict(a, b).collect()
    out = rows(union_fill(a, b), "year")
    assert out[0]["transect"] is None and out[1]["transect"] == 7


def test_n2_strict_sum_and_n3(spark, rows):
    df = spark.createDataFrame([("g", None), ("g", None), ("h", 1.0)], "k string, v double")
    out = {r["k"]: r for r in rows(df.groupBy("k").agg(S.sum_strict("v").alias("s"), S.sum_na0("v").alias("z"),
                                                        S.n_distinct_na("v").alias("nd")))}
    assert out["g"]["s"] is None and out["g"]["z"] == 0 and out["g"]["nd"] == 1
    assert out["h"]["s"] == 1.0 and out["h"]["nd"] == 1


def test_nan_to_null(spark, rows):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int")
    out = S.nan_to_null(df).agg(F.avg("x").alias("m")).collect()[0]["m"]
    assert out == 2.0


def test_d16_rules_null_semantics(spark, rows):
    from reeflens.operators.outliers import SetRule, YearRule, drop_rule_outliers
    df = spark.createDataFrame(
        [(1, "Corredor", "Haemulidae", 2020, 5.0),    # dropped: in both sets, above limit
         (2, "Corredor", "Haemulidae", 2020, None),   # dropped: NULL biomass inside both sets
         (3, "La Paz", "Haemulidae", 2020, None),     # kept: outside the region set
         (4, None, "Haemulidae", 2020, 9.0),          # kept: NULL region is not a member
         (5, "Santa Rosalia", "Labridae", 2022, 2.6),  # dropped by the year rule
         (6, "Santa Rosalia", "Labridae", None, 2.6),  # dropped: NULL year -> NULL predicate
         (7, "Santa Rosalia", "Labridae", 2021, 2.6)],  # kept
        "id int, region string, family string, year int, biomass double")
    out = drop_rule_outliers(df, [SetRule(("Corredor", "Santa Rosalia"), ("Haemulidae", "Carangidae"), 3.0)],
                             [YearRule("Santa Rosalia", 2022, 2.5)])
    assert sorted(r["id"] for r in out.collect()) == [3, 4, 7]


def test_d4_mixed_grain(spark, rows):
    from reeflens.operators.trends import mixed_grain
    df = _survey(spark, [(2020, "A", "P", "r", 5.0, 1, 1.0), (2020, "A", "P", "r", 5.0, 2, 3.0),
                         (2020, "SR", "P", "s", 5.0, 1, 2.0), (2020, "SR", "P", "s", 5.0, 2, 4.0),
                         (2020, None, "P", "n", 5.0, 1, 7.0)])
    out = rows(mixed_grain(df, "biomass", "SR"), "region", "transect")
    assert [(r["region"], r["transect"], r["biomass"]) for r in out] == \
        [("A", None, 2.0), ("SR", 1, 2.0), ("SR", 2, 4.0)]


def test_d8_order_of_operations(spark, rows):
    import dataclasses

    from reeflens.plans.fish import species_functional, top_fish
    p = dataclasses.replace(REFERENCE, top_k=3)
    cols = ("year int, region string, protection_level string, reef string, functional_name string, "
            "species string, biomass double, period string")
    h = "Histórico (1998-2013)"
    data = [(2010, "Loreto", "P", "r1", "GenPred_solitary", "A", 10.0, h),
            (2010, "Loreto", "P", "r1", "Other", "E", 9.0, h),
            (2010, "Loreto", "P", "r1", "Plank", "B", 8.0, h),
            (2010, "Loreto", "P", "r2", "Pelagic", "B", 100.0, h),      # removed before ranking
            (2010, "Loreto", "P", "r1", "Crip_solitary", "C", 6.0, h),
            (2010, "Loreto", "P", "r1", "Pelagic", "C", 20.0, h),       # removed before ranking
            (2010, "Loreto", "P", "r1", "EpiBent_schooling", "D", 1.0, h),
            (2010, "La Paz", "P", "r1", "Plank", "Z", 1000.0, h),       # other band
            (2010, "Cabo Pulmo", "P", "r1", "Plank", "Y", 500.0, h)]    # excluded region
    bf = spark.createDataFrame(data, cols)
    lats = spark.createDataFrame([("Loreto", 26.0), ("La Paz", 24.1), ("Cabo Pulmo", 27.0)],
                                 "region string, lat double")
    out = rows(top_fish(bf, species_functional(bf), lats, p, "north", 3), "species_ord")
    assert [(r["species"], r["functional_name"]) for r in out] == \
        [("B", "Planctívoros"), ("A", "Depredadores solitarios")]
    # shares are taken over all five species of the band (total 34), not the survivors
    assert [r["total_biomass"] for r in out] == [34.0, 34.0]
    assert [round(r["rel_biomass"], 6) for r in out] == [23.529412, 29.411765]
    assert out[1]["species_key"] == "A___" + h


def test_quartiles_of_a_hot_species_with_distinct_sizes(spark):
    from reeflens.operators.outliers import species_quartiles
    hot = [("hot", float(v * 7919 % 5003)) for v in range(3000)]
    rest = [(f"s{i % 40}", float(i % 13)) for i in range(4000)] + [(None, 2.0), (None, 4.0), ("none", None)]
    got = {r["species"]: (r["q1"], r["q3"]) for r in species_quartiles(
        spark.createDataFrame(hot + rest, "species string, size double")).collect()}
    import numpy as np
    groups = {}
    for k, v in hot + rest:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert got == {k: tuple(pytest.approx(np.quantile(v, q)) for q in (0.25, 0.75)) for k, v in groups.items()}
