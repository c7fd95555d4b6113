"""Shares, top-k with ties and label orderings.

Top-k uses ``rank() <= k`` over a window; Spark adds a ``WindowGroupLimit``
below the shuffle, so each task forwards at most k rows (plus ties) per
group and a hot group cannot overload the final task.  Group totals are
plain aggregates (partial on the map side) joined back to the surviving
rows, never a whole-partition window over all rows of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import within_key
from ..functions.semantics import safe_div, sum_na0
from .joins import _null_safe_join


def top_n_ties(df: DataFrame, k: int, by: str, part_cols: Sequence[str]) -> DataFrame:
    """``top_n(k, by)`` per group -- ties kept, NULL weights dropped."""
    w = Window.partitionBy(*part_cols).orderBy(F.col(by).desc())
    return (df.filter(F.col(by).isNotNull())
              .withColumn("_rk", F.rank().over(w))
              .filter(F.col("_rk") <= k)
              .drop("_rk"))


def group_totals(df: DataFrame, value: str, part_cols: Sequence[str], total: str) -> DataFrame:
    """``sum(value, na.rm = TRUE)`` per group (0 for an all-NULL group)."""
    return df.groupBy(*part_cols).agg(sum_na0(value).alias(total))


def top_n_with_share(df: DataFrame, k: int, value: str, part_cols: Sequence[str],
                     total: str, share: str) -> DataFrame:
    """W2 + W3: group total and percent share over *all* rows, then top k.

    Equivalent to the grouped ``mutate(total = sum(x), share = x / total * 100)``
    followed by ``top_n``: the share is computed from the total of every
    row, but only for rows that survive the top-k filter.
    """
    totals = group_totals(df, value, part_cols, total)
    top = top_n_ties(df, k, value, part_cols)
    out = _null_safe_join(top, totals, list(part_cols), "left")
    return out.withColumn(share, safe_div(F.col(value), F.col(total)) * F.lit(100))


def reorder_within(df: DataFrame, x: str, by: str, within: str, key_col: str,
                   ord_col: str, figures: Sequence[str] = ()) -> DataFrame:
    """``reorder_within(x, by, within)``.

    ``key_col`` is ``x___within`` (NULL rendered ``NA``); ``ord_col`` is the
    1-based position of the key inside its panel, ordered by the mean of
    ``by`` over the key's rows and then by the key.  ``figures`` tells apart
    panels of several figures in one table.
    """
    wk = Window.partitionBy(*figures, within, key_col)
    wp = Window.partitionBy(*figures, within).orderBy(F.col("_m").asc_nulls_last(), F.col(key_col))
    return (df.withColumn(key_col, within_key(x, within))
              .withColumn("_m", F.avg(by).over(wk))
              .withColumn(ord_col, F.dense_rank().over(wp))
              .drop("_m"))


def order_by_mean(df: DataFrame, x: str, by, ord_col: str) -> DataFrame:
    """P20: ``reorder(x, by)`` -- rank of each ``x`` by the mean of ``by``.

    The ranking runs over one row per distinct ``x`` (a handful of regions
    in a chart table) and is joined back.
    """
    by_col = F.col(by) if isinstance(by, str) else by
    means = df.groupBy(x).agg(F.avg(by_col).alias("_m"))
    ranks = means.select(
        x, F.dense_rank().over(Window.orderBy(F.col("_m").asc_nulls_last(), F.col(x))).alias(ord_col))
    return _null_safe_join(df, ranks, [x], "left")


def fill_share(df: DataFrame, y: str, part_cols: Sequence[str], out: str = "share") -> DataFrame:
    """``position = "fill"`` -- each bar segment as a share of its bar."""
    w = Window.partitionBy(*part_cols)
    return df.withColumn(out, safe_div(F.col(y), F.sum(y).over(w)))


def stack_extents(df: DataFrame, y: str, part_cols: Sequence[str], order_col: str,
                  lo: str = "ymin", hi: str = "ymax") -> DataFrame:
    """Stacked-bar extents; the first level is drawn on top, as ggplot does."""
    w = (Window.partitionBy(*part_cols).orderBy(F.col(order_col).desc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(hi, F.sum(y).over(w)).withColumn(lo, F.col(hi) - F.col(y))
