"""Label, category and ordering expressions (factor recodes, periods, bands).

R factors carry both a label and a level order.  Spark has no factor type, so
a recode yields the label as a string column plus an ``<name>_ord`` integer
column holding the level position (1-based); sorting by it reproduces the
factor order.  Unknown values map to NULL in both columns, as R does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .semantics import ColumnOrName, _c, ifelse_na, in_set, round_half_even


def recode(x: ColumnOrName, levels: Sequence[str], labels: Sequence[str] | None = None) -> Column:
    """``factor(x, levels, labels)`` as a label column; unknown -> NULL."""
    labels = list(levels) if labels is None else list(labels)
    if len(labels) != len(levels):
        raise ValueError("levels and labels must have the same length")
    x = _c(x)
    expr = None
    for lev, lab in zip(levels, labels):
        expr = F.when(x == F.lit(lev), F.lit(lab)) if expr is None else expr.when(x == F.lit(lev), F.lit(lab))
    return expr if expr is not None else F.lit(None).cast("string")


def level_order(x: ColumnOrName, levels: Sequence[str]) -> Column:
    """Position (1-based) of ``x`` among ``levels``; NULL when absent."""
    x = _c(x)
    expr = None
    for i, lev in enumerate(levels, start=1):
        expr = F.when(x == F.lit(lev), F.lit(i)) if expr is None else expr.when(x == F.lit(lev), F.lit(i))
    return expr if expr is not None else F.lit(None).cast("int")


def with_factor(df: DataFrame, name: str, levels: Sequence[str], labels: Sequence[str] | None = None,
                source: str | None = None) -> DataFrame:
    """Replace ``name`` by its recoded label and add ``<name>_ord``."""
    src = F.col(source or name)
    labels = list(levels) if labels is None else list(labels)
    return df.withColumns({
        f"{name}_ord": level_order(src, levels),
        name: recode(src, levels, labels),
    })


def period_label(year: ColumnOrName, cuts: Sequence[tuple[int | None, int | None, str]]) -> Column:
    """``case_when`` over inclusive year ranges; first match wins, else NULL.

    ``cuts`` is a list of ``(lo, hi, label)`` with ``None`` for an open end.
    A NULL year matches nothing (``case_when`` treats NA as FALSE).
    """
    y = _c(year)
    expr = None
    for lo, hi, lab in cuts:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (y >= F.lit(lo))
        if hi is not None:
            cond = cond & (y <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def lat_band(lat: ColumnOrName, cut: float, above: str, below: str) -> Column:
    """``ifelse(round(lat, 0) >= cut, above, below)``; NULL lat -> NULL."""
    return ifelse_na(round_half_even(lat) >= F.lit(cut), above, below)


def taxon_label(taxa3: ColumnOrName, taxa2: ColumnOrName, taxa3_keep: Sequence[str],
                taxa2_keep: Sequence[str]) -> Column:
    """``taxa3`` names first, then ``taxa2`` names; anything else -> NULL."""
    t3, t2 = _c(taxa3), _c(taxa2)
    expr = None
    for v in taxa3_keep:
        expr = F.when(t3 == F.lit(v), F.lit(v)) if expr is None else expr.when(t3 == F.lit(v), F.lit(v))
    for v in taxa2_keep:
        expr = F.when(t2 == F.lit(v), F.lit(v)) if expr is None else expr.when(t2 == F.lit(v), F.lit(v))
    return expr


def collapse_species(species: ColumnOrName, pattern: str, label: str, na_aware: bool) -> Column:
    """Any species whose name contains ``pattern`` becomes ``label``.

    ``na_aware=False`` is ``case_when(str_detect(x, p) ~ label, TRUE ~ x)``
    (NULL name stays NULL via the default branch); ``na_aware=True`` is
    ``ifelse(str_detect(x, p), label, x)`` which also keeps NULL.
    """
    s = _c(species)
    hit = s.contains(pattern)
    if na_aware:
        return ifelse_na(hit, label, s)
    return F.when(hit, F.lit(label)).otherwise(s)


def history_label(year: ColumnOrName, current_year: int, history: str, current: str) -> Column:
    """``ifelse(year < current, history, current)``; NULL year -> NULL."""
    return ifelse_na(_c(year) < F.lit(current_year), history, current)


def commercial_label(x: ColumnOrName, yes_value: str, yes_label: str, no_label: str) -> Column:
    """``ifelse(commercial == yes, yes_label, no_label)``; NULL stays NULL."""
    return ifelse_na(_c(x) == F.lit(yes_value), yes_label, no_label)


def within_key(x: ColumnOrName, within: ColumnOrName, sep: str = "___") -> Column:
    """P19 key of ``reorder_within``: ``paste(x, within, sep = '___')``."""
    return F.concat(F.coalesce(_c(x).cast("string"), F.lit("NA")), F.lit(sep),
                    F.coalesce(_c(within).cast("string"), F.lit("NA")))


__all__ = [
    "recode", "level_order", "with_factor", "period_label", "lat_band", "taxon_label",
    "collapse_species", "history_label", "commercial_label", "within_key", "in_set",
]
