"""The parametric part ``A * B`` of a joint model (S8): treatment contrasts with standard errors.

The model has a smooth and an intercept per cell (a, b).  Its normal
equations are arrow-shaped: a block of spline coefficients per cell, bordered
by the contrasts of ``A * B``, which meet each block in its intercept only.
Taking a block out leaves one number per cell, the information on its intercept,
``1 / var(level)``; :func:`~reeflens.operators.smooth.smooth_trend` gives level
and standard error so, from the penalised system of the cell alone.  The
contrasts are as many as the cells, so what is left is solved by the levels
themselves: every term is a sum of at most four of them, and their errors are
independent given the penalties and the common scale.

A term is one row, found by joins on the two factors; no matrix over all cells
is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tails import f_tail_function


def _tested(names: list[str]):
    tail = f_tail_function()

    def tested(batches):
        import numpy as np

        for pdf in batches:
            t, room = pdf["t"].to_numpy(float), pdf["_room"].to_numpy(float)
            fine = np.isfinite(t) & (room > 0.5)
            p = np.where(fine, tail(np.where(fine, t * t, 1.0), np.ones(len(pdf)), np.where(fine, room, 1.0)), np.nan)
            yield pdf.assign(p=p)[names].astype(object).where(lambda f: f.notna(), None)

    return tested


def parametric_terms(models: DataFrame, a: str, b: str) -> DataFrame:
    """``(term, a, b, estimate, std_error, t, p)``: one row per term of ``a * b``.

    ``models`` are the cells of a joint fit.  The least level of each factor, in
    code-point order, is its reference.  Terms are named as in the printed
    model: ``(Intercept)``, ``a[level]``, ``b[level]``, ``a[level]:b[level]``; the
    columns ``a`` and ``b`` hold the levels, NULL where the term has none.  A term
    whose contrast needs a cell without rows has NULL figures.  An empty
    table of models gives no terms.
    """
    cells = models.select(F.col(a).cast("string").alias("_a"), F.col(b).cast("string").alias("_b"), F.col("level").alias("_l"),
                          (F.col("level_se") * F.col("level_se")).alias("_v"))
    room = models.agg(F.sum("n") - F.sum("edf")).scalar()
    a0, b0 = cells.agg(F.min("_a")).scalar(), cells.agg(F.min("_b")).scalar()
    of_a = cells.where(F.col("_b") == b0).select("_a", F.col("_l").alias("_la"), F.col("_v").alias("_va"))
    of_b = cells.where(F.col("_a") == a0).select("_b", F.col("_l").alias("_lb"), F.col("_v").alias("_vb"))
    origin = cells.where((F.col("_a") == a0) & (F.col("_b") == b0)).agg(F.first(F.struct("_l", "_v"))).scalar()
    cells = cells.withColumns({"_l0": origin.getField("_l"), "_v0": origin.getField("_v")})
    none = F.lit(None).cast("string")
    # main effects stand for every level of a factor, interactions for every cell off the references
    mains_a = cells.where(F.col("_a") != a0).select("_a", "_l0", "_v0").distinct().join(of_a, "_a", "left").select(
        F.lit("a").alias("kind"), "_a", none.alias("_b"), (F.col("_la") - F.col("_l0")).alias("estimate"), (F.col("_va") + F.col("_v0")).alias("var"))
    mains_b = cells.where(F.col("_b") != b0).select("_b", "_l0", "_v0").distinct().join(of_b, "_b", "left").select(
        F.lit("b"), none, "_b", F.col("_lb") - F.col("_l0"), F.col("_vb") + F.col("_v0"))
    both = cells.where((F.col("_a") != a0) & (F.col("_b") != b0)).join(of_a, "_a", "left").join(of_b, "_b", "left").select(
        F.lit("ab"), "_a", "_b", F.col("_l") + F.col("_l0") - F.col("_la") - F.col("_lb"), F.col("_v") + F.col("_v0") + F.col("_va") + F.col("_vb"))
    first = cells.agg(F.first("_l0").alias("_l0"), F.first("_v0").alias("_v0"), F.count(F.lit(1)).alias("c")).where("c > 0").select(
        F.lit("1"), none, none, "_l0", "_v0")
    terms = mains_a.union(mains_b).union(both).union(first)

    name = lambda c, v: F.concat(F.lit(f"{c}["), F.col(v), F.lit("]"))
    term = F.when(F.col("kind") == "a", name(a, "_a")).when(F.col("kind") == "b", name(b, "_b")).when(
        F.col("kind") == "ab", F.concat(name(a, "_a"), F.lit(":"), name(b, "_b"))).otherwise(F.lit("(Intercept)"))
    out = terms.select(term.alias("term"), F.col("_a").alias(a), F.col("_b").alias(b), "estimate", F.sqrt("var").alias("std_error"))
    out = out.withColumn("t", F.when(F.col("std_error") > 0, F.col("estimate") / F.col("std_error"))).withColumn("_room", room)
    kept = T.StructType([*[f for f in out.schema.fields if f.name != "_room"], T.StructField("p", T.DoubleType())])
    return out.mapInPandas(_tested(kept.fieldNames()), kept)
