"""Missing-value rules of the survey analysis as Spark Column expressions.

The analysis was specified with R / dplyr semantics, which differ from SQL
in how NULL (R's NA) flows through aggregates, joins, membership tests and
conditionals.  Every pipeline routes those cases through the helpers below so
that the rule is written once.  All helpers return plain ``Column``
expressions: they stay inside whole-stage codegen and are planned by Catalyst
as ordinary partial/final aggregates.

"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- aggregates --------------------------------------------------------------

def sum_strict(x: ColumnOrName) -> Column:
    """``sum(x)`` without ``na.rm`` -- NULL as soon as one input is NULL."""
    x = _c(x)
    return F.when(F.count(F.lit(1)) == F.count(x), F.sum(x))


def mean_strict(x: ColumnOrName) -> Column:
    """``mean(x)`` without ``na.rm`` -- NULL as soon as one input is NULL."""
    x = _c(x)
    return F.when(F.count(F.lit(1)) == F.count(x), F.avg(x))


def sum_na0(x: ColumnOrName) -> Column:
    """``sum(x, na.rm = TRUE)`` -- NULLs skipped, all-NULL group gives 0."""
    return F.coalesce(F.sum(_c(x)), F.lit(0))


def mean_na(x: ColumnOrName) -> Column:
    """``mean(x, na.rm = TRUE)``.  An all-NULL group gives NULL (R: NaN)."""
    return F.avg(_c(x))


def sd_na(x: ColumnOrName) -> Column:
    """Sample standard deviation, NULL for fewer than two values."""
    return F.stddev_samp(_c(x))


def n_rows() -> Column:
    """``n()`` counts rows, NULL values included."""
    return F.count(F.lit(1))


def n_distinct_na(x: ColumnOrName) -> Column:
    """``n_distinct(x)`` -- NULL counts as one more distinct value."""
    x = _c(x)
    return F.count_distinct(x) + F.max(F.when(x.isNull(), 1).otherwise(0))


# --- predicates and conditionals ----------------------------------------------

def in_set(x: ColumnOrName, values: Iterable) -> Column:
    """``x %in% S`` -- never NULL; a NULL ``x`` is simply not a member."""
    return F.coalesce(_c(x).isin(list(values)), F.lit(False))


def not_in_set(x: ColumnOrName, values: Iterable) -> Column:
    """``!(x %in% S)`` -- TRUE for NULL ``x``, so such rows are kept."""
    return ~in_set(x, values)


def ifelse_na(cond: Column, yes, no) -> Column:
    """``ifelse(cond, yes, no)`` -- a NULL condition yields NULL."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def round_half_even(x: ColumnOrName) -> Column:
    """``round(x, 0)`` rounds halves to even (24.5 -> 24, 25.5 -> 26)."""
    return F.rint(_c(x))


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Division that yields NULL instead of raising on a zero divisor."""
    return F.try_divide(_c(a), _c(b))


def to_double(x: ColumnOrName) -> Column:
    """``as.numeric(x)`` -- unparsable text and the text NaN become NULL, never an error.

    Spark's cast also accepts a trailing type suffix (``3.5d``) that R
    rejects, so such strings are turned into NULL first.
    """
    x = _c(x)
    s = x.cast("string")
    return F.when(s.rlike(r"[dDfF]\s*$"), F.lit(None).cast(DoubleType())).otherwise(
        F.nanvl(s.try_cast(DoubleType()), F.lit(None).cast(DoubleType()))
    )


def paste_na(x: ColumnOrName) -> Column:
    """``paste`` renders NA as the text ``NA``."""
    return F.coalesce(_c(x).cast("string"), F.lit("NA"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Section 1.5: NaN becomes NULL in every floating column, once, at the source.

    R's ``na.rm = TRUE`` drops NaN as well as NA, while Spark's ``avg`` and
    ``stddev_samp`` would propagate NaN.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
