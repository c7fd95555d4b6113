
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def test_outlier_screen_on_events(spark):
    kept = entry.queries()["size_outliers_events"](spark, SF)
    assert kept.count() == 9529                       # 471 of 10,000 flagged
    by_type = {r["event_type"]: r["n"] for r in kept.groupBy("event_type").agg(F.count("*").alias("n")).collect()}
    assert by_type["click"] == 1907 and by_type["view"] == 1891


def test_shannon_units(spark):
    # distinct (region, reef, transect) with a quantity and a species, counted from the raw tables
    assert entry.queries()["shannon_by_transect"](spark, SF).count() == 10378


def test_richness_trend_rows(spark):
    assert entry.queries()["richness_by_region"](spark, SF).count() == 126
