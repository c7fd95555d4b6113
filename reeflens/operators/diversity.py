"""Diversity indices: species richness (D12) and Shannon's H.

Shannon is computed in long form -- no species matrix is ever built, so the
number of species is unbounded.  Plan: (1) quantity summed per (unit,
species) with map-side partial aggregation; (2) one hash shuffle on the unit
keys carries the per-species rows; the unit total (a window over the unit)
and the final ``-sum(p * ln p)`` aggregate both run on that one partitioning.
The rows of one unit after step (1) are its distinct species, so a hot
sampling unit still holds at most one row per species.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import numeric_columns
from ..functions.semantics import mean_strict, n_distinct_na, paste_na, sum_na0
from .trends import REEF_KEYS, TRANSECT_KEYS


def richness(df: DataFrame, dims: Sequence[str] = ("label",), species: str = "species") -> DataFrame:
    """Distinct species per transect (NULL counts once), mean per reef."""
    t = df.groupBy(*TRANSECT_KEYS, *dims).agg(n_distinct_na(species).alias("richness"))
    return t.groupBy(*REEF_KEYS, *dims).agg(mean_strict("richness").alias("richness"))


def shannon(df: DataFrame, unit_cols: Sequence[str] = ("region", "reef", "transect"),
            species: str = "species", quantity: str = "quantity",
            numeric_unit_cols: Sequence[str] | str = (), id_col: str = "transect_id",
            out: str = "shannon_index") -> DataFrame:
    """Shannon index per sampling unit, pooling everything else.

    Rows with a NULL quantity or species are dropped first; quantities are
    summed per (unit, species); ``H = -sum(p * ln p)`` over species with
    ``p = q / total`` and ``q > 0`` (0 * ln 0 counts as 0; a unit whose total
    is 0 gets 0).  Negative quantities raise, as the reference index does.

    ``numeric_unit_cols`` reproduces a quirk of the matrix form: a numeric
    unit column (e.g. ``transect``) left in the species matrix is counted
    as one more species whose abundance is its own value.  Off by default;
    ``"auto"`` picks the numeric unit columns from the schema (P4), which is
    what the matrix form does.
    """
    unit_cols = list(unit_cols)
    if numeric_unit_cols == "auto":
        numeric_unit_cols = numeric_columns(df, unit_cols)
    base = df.filter(F.col(quantity).isNotNull() & F.col(species).isNotNull())
    q = (base.groupBy(*unit_cols, species)
             .agg(sum_na0(quantity).alias("_q"))
             .select(*unit_cols, F.col(species).cast("string").alias("_sp"), "_q"))
    if numeric_unit_cols:
        extra = None
        for c in numeric_unit_cols:
            e = (df.filter(F.col(quantity).isNotNull() & F.col(species).isNotNull())
                   .select(*unit_cols).distinct()
                   .select(*unit_cols, F.lit(f"__unit_{c}").alias("_sp"),
                           F.col(c).cast("double").alias("_q")))
            extra = e if extra is None else extra.unionByName(e)
        q = q.unionByName(extra)
    q = q.withColumn("_q", F.when(F.col("_q") < 0,
                                  F.raise_error(F.lit("shannon: quantities must be non-negative")))
                      .otherwise(F.col("_q")).cast("double"))
    # ln T - sum(q ln q) / T: both sums in one aggregate, so a large unit is reduced in every task
    total, logs = F.sum("_q"), F.sum(F.when(F.col("_q") > 0, F.col("_q") * F.log("_q")).otherwise(F.lit(0.0)))
    several = F.count_if(F.col("_q") > 0) > 1
    h = q.groupBy(*unit_cols).agg(
        F.when(several, F.log(total) - logs / total).otherwise(F.lit(0.0)).alias(out))
    key = F.concat_ws("_", *[paste_na(c) for c in unit_cols])
    return h.select(key.alias(id_col), *unit_cols, out)
