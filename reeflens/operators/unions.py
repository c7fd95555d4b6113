"""Unions by column name (U1, U2) and long-to-wide reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wide import WIDTH, wide_blocks


def union_strict(*dfs: DataFrame) -> DataFrame:
    """``rbind`` -- union all by name; a missing column raises.

    Duplicates are kept: a survey present in two inputs counts twice.
    """
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def union_fill(*dfs: DataFrame) -> DataFrame:
    """``bind_rows`` -- union all by name; missing columns become NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def pivot_wider(df: DataFrame, id_cols: Sequence[str], names_from: str, values_from: str,
                values: Sequence | None = None, fill=0, width: int = WIDTH) -> DataFrame:
    """``pivot_wider(names_from, values_from, values_fill = fill)``.

    Optional presentation output only -- every metric of the analysis is
    computed in long form.  ``values`` names the columns; without it they are
    the names in the data, a missing one as ``NA``.  More than ``width`` names do
    not go into one row: :func:`~reeflens.operators.wide.wide_blocks` gives them
    in column blocks.  Only combinations without a row get ``fill``; a row with
    a NULL value stays NULL.
    """
    if values is None:
        wide = wide_blocks(df, id_cols, names_from, values_from, fill, width)
        if wide.n_blocks > 1:
            raise ValueError(f"{wide.n_names} names are more than {width} columns; take wide_blocks")
        return wide.block(0)
    wide = df.groupBy(*id_cols).pivot(names_from, list(values)).agg(
        F.first(values_from).alias("value"), F.count(F.lit(1)).alias("rows"))
    cells = [F.when(F.coalesce(F.col(f"`{v}_rows`"), F.lit(0)) == 0, F.lit(fill)).otherwise(F.col(f"`{v}_value`")).alias(str(v))
             for v in values]
    return wide.select(*id_cols, *cells)
