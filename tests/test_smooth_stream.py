"""D11 properties and the incremental survey ingest."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reeflens.operators.smooth import fitted_values, smooth_trend
from reeflens.streaming.ingest import ingest_exports


def test_smooth_recovers_line_and_bounds_edf(spark):
    rows = [("a", y, 2.0 + 0.5 * (y - 2000)) for y in range(2000, 2020)]
    rows += [("b", y, 10.0 + ((y * 7919) % 13) / 3.0) for y in range(2000, 2020)]
    df = spark.createDataFrame(rows, "s string, year int, v double")
    models = smooth_trend(df, "year", "v", ["s"], k=8)
    m = {r["s"]: r for r in models.collect()}
    assert 2 - 1e-6 <= m["a"]["edf"] <= 8 and 2 - 1e-6 <= m["b"]["edf"] <= 8
    assert m["a"]["edf"] == pytest.approx(2.0, abs=0.05)
    fit = fitted_values(df, models, "year", ["s"], k=8).filter(F.col("s") == "a").collect()
    for r in fit:
        assert r["fitted"] == pytest.approx(r["v"], abs=1e-4)


def test_ingest_appends_new_files_only(spark):
    schema = T.StructType([T.StructField("Label", T.StringType()), T.StructField("Year", T.IntegerType()),
                           T.StructField("Latitude", T.DoubleType()), T.StructField("Family", T.StringType()),
                           T.StructField("Biomass", T.DoubleType())])
    base = tempfile.mkdtemp(prefix="reeflens-ingest-")
    src, table, ckpt = (os.path.join(base, d) for d in ("src", "table", "ckpt"))
    spark.createDataFrame([("PEC", 2020, 24.5, "Labridae", 1.0), ("INV", 2020, 25.5, None, float("nan"))],
                          schema).coalesce(1).write.parquet(os.path.join(src, "batch1"))
    q = ingest_exports(spark, os.path.join(src, "*"), table, schema, checkpoint=ckpt, has_row_id=False)
    q.awaitTermination()
    out = spark.read.parquet(table)
    assert out.count() == 2
    assert sorted(r["degree"] for r in out.collect()) == [24.0, 26.0]
    assert out.filter(F.col("biomass").isNull()).count() == 1
    spark.createDataFrame([("PEC", 2021, 26.0, "Labridae", 2.0)], schema).coalesce(1) \
         .write.parquet(os.path.join(src, "batch2"))
    q = ingest_exports(spark, os.path.join(src, "*"), table, schema, checkpoint=ckpt, has_row_id=False)
    q.awaitTermination()
    assert spark.read.parquet(table).count() == 3


def test_smooth_short_series(spark):
    rows = [("two", 2000, 1.0), ("two", 2001, 3.0),
            ("three", 2000, 1.0), ("three", 2005, 2.0), ("three", 2010, 3.0),
            ("long", 2000, 0.0), ("long", 2010, 1.0)] + [("long", y, float(y % 3)) for y in range(2001, 2010)]
    df = spark.createDataFrame(rows, "s string, year int, v double")
    m = {r["s"]: r for r in smooth_trend(df, "year", "v", ["s"], k=6).collect()}
    # too short for a spline: the straight line
    assert m["two"]["lambda"] is None and m["two"]["edf"] == 2.0
    assert m["two"]["slope"] == pytest.approx(2.0) and m["two"]["intercept"] + 2000 * m["two"]["slope"] == pytest.approx(1.0)
    assert m["three"]["edf"] < 2.5
    fit = {r["year"]: r["fitted"] for r in
           fitted_values(df, smooth_trend(df, "year", "v", ["s"], k=6), "year", ["s"], k=6)
           .filter(F.col("s") == "three").collect()}
    assert fit[2005] == pytest.approx(2.0, abs=1e-3)


def test_fit_does_not_depend_on_a_constant(spark):
    import math
    rows = [("a", float(x), math.sin(x / 3) + (x * 37 % 11) / 20) for x in range(30)]
    far = 2.0 ** 30  # about 1e9, exact in binary
    fits = []
    for add in (0.0, far):
        df = spark.createDataFrame([(s, x, y + add) for s, x, y in rows], "s string, x double, y double")
        fits.append(smooth_trend(df, "x", "y", ["s"]).collect()[0])
    a, b = fits
    for c in ("edf", "lambda", "r2", "slope", "gcv"):
        assert b[c] == pytest.approx(a[c], rel=1e-4)
    assert b["intercept"] - a["intercept"] == pytest.approx(far, rel=1e-9)
    assert all(q - p == pytest.approx(far, rel=1e-9) for p, q in zip(a["coefficients"], b["coefficients"]))
