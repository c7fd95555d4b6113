"""Two-level means (D3, D4), trend summaries (D5) and the log scale.

Survey values are first summed per transect (the sampling unit), then
averaged per reef.  Both steps are ordinary hash aggregates with map-side
partial aggregation, so a reef or region holding a large share of the rows
is pre-reduced in every task before the shuffle.  A group that was not
recorded on a transect is *not* zero-filled ("presence-only" means), as in
the analysis.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import (mean_na, mean_strict, n_rows, sd_na, sum_na0, sum_strict)

REEF_KEYS = ("year", "region", "protection_level", "reef")
TRANSECT_KEYS = REEF_KEYS + ("depth", "transect")


def transect_sum(df: DataFrame, value: str, dims: Sequence[str] = (), strict: bool = False,
                 out: str | None = None) -> DataFrame:
    """Sum ``value`` per transect (and ``dims``); strict = NULL if any input is NULL."""
    agg = sum_strict if strict else sum_na0
    return df.groupBy(*TRANSECT_KEYS, *dims).agg(agg(value).alias(out or value))


def reef_mean(df: DataFrame, value: str, dims: Sequence[str] = (), strict: bool = False,
              out: str | None = None) -> DataFrame:
    """D3: transect sums averaged per (year, region, protection_level, reef, dims).

    ``strict=True`` reproduces ``sum(x)`` / ``mean(x)`` without ``na.rm``;
    ``strict=False`` reproduces ``na.rm = TRUE`` (all-NULL transect sums to 0).
    """
    name = out or value
    t = transect_sum(df, value, dims, strict, out=name)
    agg = mean_strict if strict else mean_na
    return t.groupBy(*REEF_KEYS, *dims).agg(agg(name).alias(name))


def mixed_grain(df: DataFrame, value: str, transect_region: str) -> DataFrame:
    """Reef means for every region except one, transect sums for that one.

    One aggregate gives the transect sums of all regions; a second one takes
    their strict means with ``depth`` and ``transect`` as further keys in the
    one region (where a group is a single transect) and NULL elsewhere.  The
    input is scanned once.  A NULL region drops out, as ``!=`` and ``==``
    both drop it in the analysis.
    """
    t = transect_sum(df, value, strict=True).where(F.col("region").isNotNull())
    one = F.col("region") == F.lit(transect_region)
    keyed = t.select(*REEF_KEYS, F.when(one, F.col("depth")).alias("depth"),
                     F.when(one, F.col("transect")).alias("transect"), value)
    means = keyed.groupBy(*REEF_KEYS, "depth", "transect").agg(mean_strict(value).alias(value))
    return means.select(*REEF_KEYS, value, "depth", "transect")


def trend_summary(df: DataFrame, value: str, keys: Sequence[str], with_sd_n: bool = False,
                  mean_name: str | None = None, se_name: str | None = None) -> DataFrame:
    """Mean, (sd, n), standard error of ``value`` per ``keys``.

    ``se = sd(value, na.rm) / sqrt(n())`` where ``n()`` counts all rows,
    NULL values included (N4).
    """
    mean_name = mean_name or f"mean_{value}"
    se_name = se_name or f"se_{value}"
    if with_sd_n:
        sd_name = f"sd_{value}"
        return (df.groupBy(*keys)
                  .agg(mean_na(value).alias(mean_name), sd_na(value).alias(sd_name),
                       n_rows().alias("n"))
                  .withColumn(se_name, F.col(sd_name) / F.sqrt(F.col("n"))))
    return (df.groupBy(*keys)
              .agg(mean_na(value).alias(mean_name),
                   (sd_na(value) / F.sqrt(n_rows())).alias(se_name)))


def with_bounds(df: DataFrame, mean_col: str, se_col: str, lo: str = "ymin",
                hi: str = "ymax") -> DataFrame:
    """Error-bar extents ``mean -/+ se`` of a chart table."""
    return df.withColumns({lo: F.col(mean_col) - F.col(se_col), hi: F.col(mean_col) + F.col(se_col)})


def log_scale(df: DataFrame, mean_col: str = "mean_quantity",
              se_col: str = "se_quantity") -> DataFrame:
    """``log1p`` of the mean and of the standard error, with bar extents.

    ``log1p(se)`` is not the standard error of a log; the chart uses it as is.
    """
    return (df.withColumns({"log_quan": F.log1p(F.col(mean_col)), "se_log": F.log1p(F.col(se_col))})
              .withColumns({"ymin": F.col("log_quan") - F.col("se_log"),
                            "ymax": F.col("log_quan") + F.col("se_log")}))
