"""Sources, sinks, name cleaning, reshaping and diagnostics."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reeflens.functions.names import clean_name, clean_names
from reeflens.operators.sites import consistent_sites
from reeflens.operators.unions import pivot_wider
from reeflens.plans.charts import write_chart
from reeflens.sources.survey import load_survey, load_traits

RAW = T.StructType([T.StructField("...1", T.IntegerType()), T.StructField("Label", T.StringType()),
                    T.StructField("Year", T.IntegerType()), T.StructField("Region", T.StringType()),
                    T.StructField("Latitude", T.DoubleType()), T.StructField("Family", T.StringType()),
                    T.StructField("Biomass", T.DoubleType())])


def test_clean_names():
    assert clean_name("MaxSizeTL") == "max_size_tl"
    assert clean_name("TrophicLevel") == "trophic_level"
    assert clean_name("Protection Level") == "protection_level"
    assert clean_name("PC1") == "pc1"
    assert clean_name("Año") == "ano"
    assert clean_names(["Reef", "reef", "REEF"]) == ["reef", "reef_2", "reef_3"]


def test_load_survey_union_and_family_rule(spark):
    base = tempfile.mkdtemp(prefix="reeflens-src-")
    h, c = os.path.join(base, "historic"), os.path.join(base, "current")
    spark.createDataFrame([(1, "PEC", 2001, "A", 24.5, "Carangidae", 1.0),
                           (2, "PEC", 2001, "A", 25.5, None, 2.0),
                           (3, "PEC", 2001, "A", 25.5, "Labridae", float("nan"))], RAW).write.parquet(h)
    spark.createDataFrame([(1, "PEC", 2022, "B", 26.5, "Carangidae", 4.0)], RAW).write.parquet(c)
    s = load_survey(spark, h, c, ("Carangidae",))
    assert s.columns == ["label", "year", "region", "latitude", "family", "biomass", "degree"]
    rows = sorted(s.collect(), key=lambda r: r["year"])
    # historic: Carangidae and NULL family dropped; current export keeps Carangidae
    assert [(r["year"], r["family"]) for r in rows] == [(2001, "Labridae"), (2022, "Carangidae")]
    assert rows[0]["biomass"] is None            # NaN -> NULL at the source
    assert [r["degree"] for r in rows] == [26.0, 26.0]


def test_load_traits_csv(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="reeflens-traits-"), "traits.csv")
    with open(path, "w") as fh:
        fh.write("Species,groups_new,groups_old,functional_name,Diet,TrophicLevel,MaxSizeTL,"
                 "ReefPosition,FeedingType,Solitary,Schooling,Shoaling,Cluster,PC1,PC2\n")
        fh.write("Abudefduf troschelii,group1,group1,Plank,Planktivore,3.4,23,Bentho,Picker,0,1,0,3,0.5,-1.2\n")
    t = load_traits(spark, path)
    assert t.columns[:3] == ["species", "groups_new", "groups_old"]
    r = t.collect()[0]
    assert r["trophic_level"] == 3.4 and r["max_size_tl"] == 23 and r["pc2"] == -1.2


def test_pivot_wider_and_chart_sink(spark):
    df = spark.createDataFrame([("u", "a", 2.0), ("u", "b", 1.0), ("v", "a", 3.0)],
                               "unit string, species string, q double")
    w = {r["unit"]: r for r in pivot_wider(df, ["unit"], "species", "q", ["a", "b"]).collect()}
    assert w["v"]["b"] == 0 and w["u"]["b"] == 1.0
    out = write_chart(df, tempfile.mkdtemp(prefix="reeflens-out-"), "chart")
    assert spark.read.parquet(out).count() == 3


def test_site_report_order(spark):
    df = spark.createDataFrame([("B", "b1", 2001), ("A", "a1", 2001), ("A", "a2", 2001), ("A", "a2", 2002),
                                (None, "n", 2001)], "region string, reef string, year int")
    rep = [(r["region"], r["reef"]) for r in consistent_sites(df, min_years=1).report().collect()]
    assert rep == [("A", "a2"), ("A", "a1"), ("B", "b1"), (None, "n")]


def test_stored_survey_prunes_by_label(spark):
    import contextlib
    import io

    from reeflens.sources.survey import write_survey
    path = os.path.join(tempfile.mkdtemp(prefix="reeflens-store-"), "survey")
    write_survey(spark.createDataFrame([("PEC", 2001, 1.0), ("INV", 2001, 2.0)],
                                       "label string, year int, biomass double"), path)
    df = spark.read.parquet(path).filter(F.col("label") == "PEC").select("year", "biomass")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(label" in plan and "(label#" in plan
    assert df.count() == 1


def test_csv_export_with_na_equals_parquet(spark):
    base = tempfile.mkdtemp(prefix="reeflens-csv-")
    head = "id,Label,Year,Region,Latitude,Family,Species,Biomass,Transect"
    lines = ["1,PEC,2001,A,24.5,Labridae,s1,1.5,1", "2,PEC,2001,A,25.5,NA,s2,2.0,2", "3,PEC,NA,NA,NA,Labridae,NA,NA,NA"]
    csv = os.path.join(base, "h.csv")
    with open(csv, "w") as fh:
        fh.write("\n".join([head, *lines]) + "\n")
    types = "id int, Label string, Year int, Region string, Latitude double, Family string, Species string, Biomass double, Transect int"
    rows = [(1, "PEC", 2001, "A", 24.5, "Labridae", "s1", 1.5, 1), (2, "PEC", 2001, "A", 25.5, None, "s2", 2.0, 2),
            (3, "PEC", None, None, None, "Labridae", None, None, None)]
    spark.createDataFrame(rows, types).write.parquet(os.path.join(base, "h"))
    a = load_survey(spark, csv, csv, ("Carangidae",))
    b = load_survey(spark, os.path.join(base, "h"), os.path.join(base, "h"), ("Carangidae",))
    assert a.dtypes == b.dtypes
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    # the missing family drops out of the historic export only; missing species and biomass stay missing
    assert a.count() == 5 and a.where("species is null and biomass is null").count() == 2


def test_pivot_wider_keeps_missing_values(spark):
    df = spark.createDataFrame([("u", "a", None), ("u", "b", 1.0), ("v", "a", 3.0)], "unit string, species string, q double")
    w = {r["unit"]: (r["a"], r["b"]) for r in pivot_wider(df, ["unit"], "species", "q", ["a", "b"]).collect()}
    assert w == {"u": (None, 1.0), "v": (3.0, 0.0)}


def test_traits_csv_with_missing_and_malformed_cells(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="reeflens-traits-"), "traits.csv")
    with open(path, "w") as fh:
        fh.write("Species,groups_new,groups_old,functional_name,Diet,TrophicLevel,MaxSizeTL,"
                 "ReefPosition,FeedingType,Solitary,Schooling,Shoaling,Cluster,PC1,PC2\n")
        fh.write('"a, b",NA,g,f,"said ""x""",about 3,12 cm,B,P,1,NA,yes,3,NA,-1.5\n')
        fh.write("c,g,g,f,d\n")
    a, c = sorted(load_traits(spark, path).collect(), key=lambda r: r["species"])
    assert (a["species"], a["groups_new"], a["diet"], a["pc2"], a["cluster"]) == ("a, b", None, 'said "x"', -1.5, 3)
    # a cell that is not a number is missing; the rest of its row stays
    assert all(a[x] is None for x in ("trophic_level", "max_size_tl", "schooling", "shoaling", "pc1"))
    assert c["diet"] == "d" and c["trophic_level"] is None and c["pc2"] is None


def test_export_has_the_survey_schema_and_preparation(spark):
    from reeflens.sources.survey import load_export
    path = os.path.join(tempfile.mkdtemp(prefix="reeflens-sargassum-"), "s.csv")
    with open(path, "w") as fh:
        fh.write("X,Label,Year,Latitude,Family,Biomass,Cover\n1,SAR,2024,24.5,NA,NaN,dense\n2,SAR,bad,25.5,Carangidae,2,NA\n")
    s = load_export(spark, path)
    assert dict(s.dtypes) == {"label": "string", "year": "int", "latitude": "double", "family": "string", "biomass": "double",
                              "cover": "string", "degree": "double"}
    one, two = sorted(s.collect(), key=lambda r: r["latitude"])
    assert (one["degree"], one["biomass"], one["family"], one["cover"]) == (24.0, None, None, "dense")
    assert (two["degree"], two["year"], two["biomass"]) == (26.0, None, 2.0)
    assert load_export(spark, path, ("Carangidae",)).count() == 0  # a missing family goes too


def test_wide_blocks_of_many_names(spark):
    from reeflens.operators.wide import wide_blocks, write_wide
    n = 10_000
    df = spark.range(2 * n).select(F.when(F.col("id") % 2 == 0, "u").when(F.col("id") < n, "v").alias("unit"),
                                   F.format_string("s%05d", F.floor(F.col("id") / 2)).alias("species"), F.col("id").cast("double").alias("q"))
    wide = wide_blocks(df, ["unit"], "species", "q", 0.0, 768)
    assert wide.n_names == n and wide.n_blocks == 14
    assert wide.names.groupBy("block").count().agg(F.max("count")).first()[0] == 768
    seen = []
    for b in (0, 7, 13):
        table = wide.block(b)
        names = table.columns[1:]
        assert len(names) == (768 if b < 13 else n - 13 * 768) and names == sorted(names)
        seen += names
        rows = {r["unit"]: r for r in table.collect()}
        assert set(rows) == {"u", "v", None}  # every unit, also one without a row in the block
        for name in (names[0], names[-1]):
            i = int(name[1:])
            assert rows["u"][name] == 2.0 * i
            assert rows["v"][name] == (2.0 * i + 1 if 2 * i + 1 < n else 0.0) and rows[None][name] == (2.0 * i + 1 if 2 * i + 1 >= n else 0.0)
    assert len(set(seen)) == len(seen)
    with pytest.raises(ValueError, match="10000 names"):
        pivot_wider(df, ["unit"], "species", "q")
    small = wide_blocks(df.where("species < 's00003'"), ["unit"], "species", "q", 0.0, 2)
    paths = write_wide(small, tempfile.mkdtemp(prefix="reeflens-wide-"))
    assert [spark.read.parquet(p).columns for p in paths] == [["unit", "s00000", "s00001"], ["unit", "s00002"]]


def test_wide_with_names_from_the_data(spark):
    from reeflens.operators.wide import wide_blocks
    df = spark.createDataFrame([("u", "b", 2.0), ("u", None, 1.0), ("v", "a", None), (None, "a", 5.0), ("u", "b", 2.0)],
                               "unit string, species string, q double")
    out = pivot_wider(df, ["unit"], "species", "q", fill=0.0)
    assert out.columns == ["unit", "a", "b", "NA"]
    assert {tuple(r) for r in out.collect()} == {("u", 0.0, 2.0, 1.0), ("v", None, 0.0, 0.0), (None, 5.0, 0.0, 0.0)}
    empty = wide_blocks(df.where("false"), ["unit"], "species", "q")
    assert empty.n_blocks == 0 and pivot_wider(df.where("false"), ["unit"], "species", "q").count() == 0
    with pytest.raises(ValueError, match="twice"):
        pivot_wider(df.withColumn("species", F.lit("unit")), ["unit"], "species", "q")


def test_ranked_sites(spark):
    df = spark.createDataFrame([("B", "b1", 2001), ("A", "a1", 2001), ("A", "a2", 2001), ("A", "a2", 2002), ("A", "a3", 2003),
                                (None, "n", 2001)], "region string, reef string, year int")
    rows = {r["reef"]: (r["region_ord"], r["place"]) for r in consistent_sites(df, min_years=1).ranked().collect()}
    assert rows == {"a2": (1, 1), "a1": (1, 2), "a3": (1, 2), "b1": (2, 1), "n": (3, 1)}


def test_union_fill_keeps_columns_of_one_side(spark):
    from reeflens.operators.unions import union_fill
    a, b = spark.createDataFrame([(1, "x")], "k int, only_a string"), spark.createDataFrame([(2, 3.0)], "k int, only_b double")
    out = union_fill(a, b)
    assert out.columns == ["k", "only_a", "only_b"] and sorted(map(tuple, out.collect())) == [(1, "x", None), (2, None, 3.0)]
