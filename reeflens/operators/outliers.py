"""Size outlier screening (D1) and the region-specific biomass rules.

D1 is a grouped ``mutate`` in the analysis (quartiles broadcast back to each
row).  Neither a window nor ``percentile`` is used: both would hold one
species' sizes in one task.  The rows of each (species, size) are counted,
the counts are range-partitioned by (species, size) and stored, the counts of
the partitions before give each partition its first rank, and the two order
statistics of each quartile are picked from the partitions that hold them.  A
species with a third of all rows, all sizes distinct, spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import in_set
from ..store import stored
from .joins import _null_safe_join

OUTLIER_COLUMNS = ("q1", "q3", "iqr", "lower_bound", "upper_bound", "size_flagged_outlier")


def species_quartiles(df: DataFrame, size_col: str = "size",
                      species_cols: Sequence[str] = ("species",)) -> DataFrame:
    """Per-group exact quartiles (type 7, linear interpolation) and 1.5 IQR fences.

    Groups without a size have no row.
    """
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(species_cols)]
    names = [f"_k{i}" for i in range(len(keys))]
    sized = df.select(*keys, F.col(size_col).cast("double").alias("_v")).where("_v is not null")
    counts = sized.groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_n"))
    # stored with its partition number, which no later plan can change
    ranged = stored(counts.repartitionByRange(*names, "_v").withColumn("_part", F.spark_partition_id()), "sizes")
    before = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(*names, "_part").agg(F.sum("_n").alias("_m")).select(
        *names, "_part", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before"),
        F.sum("_m").over(Window.partitionBy(*names)).alias("_total"))
    within = Window.partitionBy("_part", *names).orderBy("_v")
    ranks = _null_safe_join(ranged, parts, [*names, "_part"], "inner").withColumn(
        "_end", F.col("_before") + F.sum("_n").over(within))
    picks = []
    for q, prob in (("q1", 0.25), ("q3", 0.75)):
        position = (F.col("_total") - 1) * F.lit(prob)
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("_end") - F.col("_n") <= rank) & (rank < F.col("_end"))
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"{q}_{side}"))
    found = ranks.groupBy(*names, "_total").agg(*picks)
    out = [F.col(n).alias(c) for n, c in zip(names, species_cols)]
    for q, prob in (("q1", 0.25), ("q3", 0.75)):
        position = (F.col("_total") - 1) * F.lit(prob)
        lo, hi = F.col(f"{q}_lo"), F.col(f"{q}_hi")
        out.append(F.when(lo == hi, lo).otherwise(
            (F.ceil(position) - position) * lo + (position - F.floor(position)) * hi).alias(q))
    return (found.select(*out).withColumn("iqr", F.col("q3") - F.col("q1"))
                 .withColumn("lower_bound", F.col("q1") - F.lit(1.5) * F.col("iqr"))
                 .withColumn("upper_bound", F.col("q3") + F.lit(1.5) * F.col("iqr")))


def size_check(df: DataFrame, size_col: str = "size",
               species_cols: Sequence[str] = ("species",)) -> DataFrame:
    """Add q1, q3, iqr, fences and ``size_flagged_outlier`` to every row.

    The flag is TRUE when the size lies strictly outside the fences; a NULL
    size (or a group with no sizes) gives a NULL flag.  A NULL species is a
    group of its own.
    """
    q = stored(species_quartiles(df, size_col, species_cols), "quartiles")
    out = _null_safe_join(df, q, list(species_cols), "left")
    s = F.col(size_col)
    return out.withColumn(
        "size_flagged_outlier", (s < F.col("lower_bound")) | (s > F.col("upper_bound")))


def drop_flagged(df: DataFrame, flag: str = "size_flagged_outlier") -> DataFrame:
    """F8: ``filter(flag != "TRUE")`` -- keeps FALSE only; NULL flags drop."""
    return df.filter(~F.col(flag))


@dataclass(frozen=True)
class SetRule:
    """Drop rows with region in ``regions``, family in ``families`` and value above ``limit``."""
    regions: tuple[str, ...]
    families: tuple[str, ...]
    limit: float


@dataclass(frozen=True)
class YearRule:
    """Drop rows of one region and year with value above ``limit``."""
    region: str
    year: int
    limit: float


def drop_rule_outliers(df: DataFrame, set_rules: Sequence[SetRule] = (),
                       year_rules: Sequence[YearRule] = (), value: str = "biomass") -> DataFrame:
    """Hand-set outlier rules.

    ``!(region %in% R & family %in% F & biomass > t)``: membership is never
    NULL, so a NULL biomass inside both sets drops the row and outside them
    keeps it.  ``!(region == r & year == y & biomass > t)`` uses plain
    equality, so NULLs follow three-valued logic.
    """
    v = F.col(value)
    for r in set_rules:
        df = df.filter(~(in_set("region", r.regions) & in_set("family", r.families) & (v > F.lit(r.limit))))
    for r in year_rules:
        df = df.filter(~((F.col("region") == F.lit(r.region)) & (F.col("year") == F.lit(r.year))
                         & (v > F.lit(r.limit))))
    return df
