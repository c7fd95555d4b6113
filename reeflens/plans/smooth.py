"""Trend models per series (D11): the linear part, checkable in SQL.

The penalised spline fit lives in :mod:`reeflens.operators.smooth`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def linear_trend(df: DataFrame, x: str, y: str, series: Sequence[str]) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per series (regr_* aggregates)."""
    return df.groupBy(*series).agg(
        F.regr_slope(F.col(y), F.col(x).cast("double")).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x).cast("double")).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x).cast("double")).alias("r2"),
        F.regr_count(F.col(y), F.col(x).cast("double")).alias("n_points"))
