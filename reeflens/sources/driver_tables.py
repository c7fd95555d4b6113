"""A survey-shaped view over the TPC-H-style test tables, and its lookups.

The test tables are not survey data, so this adapter derives a table with the
survey's columns from ``lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈
part`` (one survey record per line item).  The pipelines run on it unchanged;
only the profile (which codes play which role) differs.

=================  ==================================================
survey column      derived from
=================  ==================================================
label              ``o_orderstatus``
year               ``year(o_orderdate)``
region             ``r_name``
reef               ``o_custkey`` (as text)
depth / transect   ``l_linestatus`` / ``l_linenumber``
protection_level   ``l_returnflag``
latitude           ``20 + 0.5 * c_nationkey`` (``.5`` values exercise half-even rounding)
family             first word of ``p_name``
species            ``p_name``
taxa2 / taxa3      ``p_type`` / ``p_brand``
trophic_level      ``p_size`` as text, ``'n/a'`` above 45 (unparsable -> NULL)
size               ``l_quantity * l_discount * 10``, NULL when there is no discount
biomass            ``l_quantity * p_size``, NULL on line 7 above 40 units
quantity           ``l_quantity``
=================  ==================================================

The rows come as two exports with capitalised names and a row id -- orders up
to 1997 and later ones -- that go through the library's own preparation: the
family exclusion on the first export only, the strict union, the name
cleaning.  Every key column and the quantity have missing values (by the
remainder of an order or customer key), and some quantities are 0.

Measures are dyadic rationals (integers, halves), so every sum is
exact in binary floating point whatever the summation order: results do not
depend on how a shuffle happened to order the rows, and two engines agree
bit for bit (a decimal measure such as ``l_extendedprice / 1000`` produces
exact decimal ties that different summation orders round differently).

Join plan: orders are joined to customers first, then line items to that on
the order key and to parts on the part key.  No join carries a hint: byte
statistics and AQE choose, so a small measured side is broadcast and fact
tables are shuffled.  Only the columns used are read (Parquet column pruning),
and label filters are pushed into the orders scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import with_clean_names
from ..functions.semantics import nan_to_null, to_double
from ..operators.outliers import SetRule, YearRule
from ..operators.unions import union_strict
from ..plans.profile import Profile
from .survey import prepare_survey_export

#: Orders up to this year are the historic export, later ones the current export.
LAST_HISTORIC_YEAR = 1997

OBSERVATION = Profile(
    fish_label="F",
    inv_label="O",
    historic_excluded_families=("cold",),
    regions=("AFRICA", "AMERICA", "ASIA", "EUROPE"),
    set_rules=(SetRule(regions=("AMERICA", "EUROPE"), families=("blue", "red"), limit=1440.0),),
    year_rules=(YearRule(region="EUROPE", year=1998, limit=1280.0),),
    transect_grain_region="EUROPE",
    chart_excluded_regions=("AMERICA",),
    protection_levels=("A", "N", "R"),
    protection_labels=("closed", "mixed use", "unprotected"),
    functional_levels=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "STANDARD", "SMALL"),
    functional_labels=("lone buyers", "bulk buyers",
                       "general stock", "small stock", "rare stock",
                       "open stock"),
    pelagic_level="SMALL",
    pelagic_label="open stock",
    periods3=((None, 1997, "early (1995-1997)"), (1998, 2000, "late (1998-2000)"),
              (2001, 2001, "2001")),
    periods2=((None, 2000, "before (1995-2000)"), (2001, 2001, "2001")),
    lat_cut=26.0,
    band_above="26 and above",
    band_below="below 26",
    coral_taxa3=("Brand#1", "Brand#2"),
    echinoderm_taxa2=("SMALL", "LARGE"),
    collapse_early=("widget", "widget sp"),
    collapse_late=("bolt", "bolt sp"),
    region_order=("MIDDLE EAST", "EUROPE", "ASIA", "AMERICA", "AFRICA"),
    richness_regions=("AFRICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    current_year=2001,
    history_label="before",
    current_label="2001",
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _latitude(nationkey: str) -> F.Column:
    return F.lit(20.0) + F.col(nationkey).cast("double") * F.lit(0.5)


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region: (n_nationkey, r_name)."""
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")


def survey_exports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The historic and the current export over the test tables, with row ids and capitalised names."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount",
        "l_returnflag", "l_linestatus")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    geo = geography(spark, sf_dir)
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey)
    orders = o.join(cust, o.o_custkey == cust.c_custkey)
    fact = li.join(orders, li.l_orderkey == orders.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    order, cust_key = F.col("o_orderkey"), F.col("o_custkey")
    holes = lambda value, key, mod, rest: F.when(key % mod != rest, value)
    raw = fact.select(
        F.monotonically_increasing_id().alias("...1"),
        (F.year("o_orderdate") <= LAST_HISTORIC_YEAR).alias("early"),
        F.col("o_orderstatus").alias("Label"),
        holes(F.year("o_orderdate").cast("int"), order, 103, 9).alias("Year"),
        holes(F.col("r_name"), cust_key, 53, 11).alias("Region"),
        holes(cust_key.cast("string"), cust_key, 59, 13).alias("Reef"),
        holes(F.col("l_linestatus"), order, 61, 10).alias("Depth"),
        holes(F.col("l_linenumber"), order, 61, 12).alias("Transect"),
        holes(F.col("l_returnflag"), order, 83, 2).alias("Protection Level"),
        holes(_latitude("c_nationkey"), order, 97, 3).alias("Latitude"),
        holes(F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)), order, 89, 7).alias("Family"),
        holes(F.col("p_name"), order, 101, 5).alias("Species"),
        holes(F.col("p_type"), order, 79, 4).alias("Taxa2"),
        holes(F.col("p_brand"), order, 73, 6).alias("Taxa3"),
        F.when(F.col("p_size") > 45, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
         .alias("Trophic Level"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity") * F.col("l_discount") * F.lit(10)).alias("Size"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_quantity") > 40), F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity") * F.col("p_size").cast("double")).alias("Biomass"),
        F.when(order % 67 == 1, F.lit(0.0)).otherwise(holes(F.col("l_quantity"), order, 71, 8)).alias("Quantity"),
    )
    return raw.where("early").drop("early"), raw.where("not early").drop("early")


def survey_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined survey (after name cleaning, with ``degree``) over the test tables."""
    historic, current = survey_exports(spark, sf_dir)
    historic = prepare_survey_export(historic, OBSERVATION.historic_excluded_families)
    current = prepare_survey_export(current)
    return nan_to_null(with_clean_names(union_strict(historic, current)))


def trait_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a trait table of text cells: some are ``NA``, some are not numbers where numbers belong.

    One row per part with the columns of ``TRAITS_SCHEMA``, as a CSV file has them.
    """
    p, key = _read(spark, sf_dir, "part"), F.col("p_partkey")
    text = lambda c: F.col(c).cast("string")
    cell = lambda value, mod, rest, other="NA": F.when(key % mod == rest, F.lit(other)).otherwise(value)
    flag = lambda mod: (key % mod == 0).cast("int").cast("string")
    return p.select(
        F.concat(text("p_name"), F.lit(" "), text("p_partkey")).alias("Species"), cell(F.col("p_brand"), 7, 1).alias("groups_new"),
        F.col("p_brand").alias("groups_old"), cell(F.col("p_type"), 11, 2).alias("functional_name"),
        F.concat(F.lit('a "quoted", part of '), text("p_size")).alias("Diet"),
        cell(cell((F.col("p_size") / 8).cast("string"), 13, 3), 17, 4, "about 3").alias("TrophicLevel"),
        cell(cell(text("p_size"), 19, 5), 23, 6, "12 cm").alias("MaxSizeTL"),
        F.col("p_type").alias("ReefPosition"), F.lit("Picker").alias("FeedingType"),
        flag(2).alias("Solitary"), flag(3).alias("Schooling"), cell(flag(5), 29, 7, "yes").alias("Shoaling"),
        (key % 9).cast("string").alias("Cluster"), (F.col("p_size") / 4 - 5).cast("string").alias("PC1"), cell((-F.col("p_size") / 2).cast("string"), 31, 8).alias("PC2"))


def commercial_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``comm_sp``: species -> 'yes' / 'no' / NULL (unknown) from part prices."""
    p = _read(spark, sf_dir, "part")
    m = F.min("p_retailprice")
    return (p.groupBy(F.col("p_name").alias("species"))
             .agg(F.when(m < 901.0, F.lit("yes")).when(m >= 902.0, F.lit("no")).alias("commercial")))


def trait_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``group_traits``: (species, trophic_level) -> functional_name, unique on the key."""
    p = _read(spark, sf_dir, "part")
    tl = to_double(F.when(F.col("p_size") > 45, F.lit("n/a")).otherwise(F.col("p_size").cast("string")))
    return (p.groupBy(F.col("p_name").alias("species"), tl.alias("trophic_level"))
             .agg(F.min("p_type").alias("functional_name")))


def latitude_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lats``: region -> mean latitude of its nations."""
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .groupBy(F.col("r_name").alias("region"))
             .agg(F.avg(_latitude("n_nationkey")).alias("lat")))
