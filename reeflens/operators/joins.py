"""Joins of the analysis: natural left joins to lookups, null-safe semi joins.

R's ``left_join(x, y)`` without ``by`` joins on every shared column name and
matches NA to NA.  ``natural_left_join`` reproduces both rules with
``eqNullSafe`` keys, which Catalyst still plans as a hash / sort-merge /
broadcast equi-join (the ``<=>`` keys become ``coalesce``/``isnull`` pairs).

No join carries a hint: lookups are read from stored tables, whose byte
statistics let Spark choose between a broadcast and a shuffle.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

def shared_keys(x: DataFrame, y: DataFrame) -> list[str]:
    """Join keys of a natural join: names present in both, in ``x`` order."""
    ycols = set(y.columns)
    keys = [c for c in x.columns if c in ycols]
    if not keys:
        raise ValueError(
            f"natural join has no shared column: {x.columns} vs {y.columns}")
    return keys


def _null_safe_join(x: DataFrame, y: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    tmp = {k: f"__rk_{i}" for i, k in enumerate(keys)}
    yr = y.select(*[F.col(c).alias(tmp[c]) if c in tmp else F.col(c) for c in y.columns])
    cond = None
    for k in keys:
        c = x[k].eqNullSafe(yr[tmp[k]])
        cond = c if cond is None else cond & c
    out = x.join(yr, cond, how)
    if how in ("left_semi", "left_anti"):
        return out
    return out.drop(*tmp.values())


def natural_left_join(x: DataFrame, y: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """``left_join(x, y)`` -- keys shared by name, NULL matches NULL.

    Result columns: all of ``x`` then the non-key columns of ``y``.  Duplicate
    lookup keys multiply rows, exactly as in dplyr (J2 fan-out).
    """
    keys = list(keys) if keys is not None else shared_keys(x, y)
    log.debug("natural join keys: %s", keys)
    return _null_safe_join(x, y, keys, "left")


def semi_join_null_safe(x: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows of ``x`` whose ``keys`` occur in ``keys_df`` (NULL = NULL).

    ``inner_join`` against a list that is unique on the keys equals a semi
    join; the semi join cannot fan out and keeps ``x``'s columns unchanged.
    """
    return _null_safe_join(x, keys_df.select(*keys), keys, "left_semi")
