"""Smooth trend per series (D11, S8): penalised cubic B-splines, GCV, tests of the terms.

The analysis fits ``gam(y ~ s(x, by = A:B) + A * B)``: one intercept and one
smooth of ``x`` per (A, B) cell.  Here each series gets a P-spline
(Eilers & Marx, 1996): ``k`` equally spaced cubic B-splines over the global
range of ``x`` and a second-difference penalty on the coefficients, whose
null space is the straight line, so an unpenalised fit keeps intercept and
slope per series.

Plan, for any number of rows:

1. ``y`` is centred on its series' mean, so that the fit does not depend on a
   constant added to it;
2. per (series, knot segment) the sums of ``t**0 .. t**6`` and ``y * t**0 ..
   t**3`` of the position ``t`` in the segment are partial aggregates: at most
   ``k - 3`` rows per series whatever the number of points;
3. ``mapInPandas`` over one row per series rebuilds the normal equations from
   the segments.  One eigen-decomposition of (normal matrix, penalty) per
   series, all series of a batch in one numpy call, makes every smoothing
   parameter of the grid cost ``k`` operations;
4. by the criterion ``"series"`` each series keeps the parameter with its own
   lowest GCV score.  By ``"joint"`` there is one score over all series,
   ``N * RSS / (N - EDF) ** 2`` with the sums of residuals and effective
   degrees of freedom, as in the analysis (:func:`joint_price`).

Knots span the global range of ``x`` (one scalar subquery), not each series'
own range: series can then be compared coefficient by coefficient.

Declared divergence from the reference model: mgcv uses a thin-plate basis, so
coefficients are not comparable digit for digit.  Properties that hold: a
straight line is recovered exactly, and ``2 <= edf <= k``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..store import stored
from .joins import _null_safe_join
from .tails import f_tail_function

LAMBDAS = tuple(float(v) for v in np.logspace(-4, 6, 41))


def _cardinal_cubic(u: Column) -> Column:
    """Cardinal cubic B-spline on [0, 4) as a Column expression."""
    return (F.when((u >= 0) & (u < 1), u * u * u / 6)
             .when((u >= 1) & (u < 2), (-3 * u * u * u + 12 * u * u - 12 * u + 4) / 6)
             .when((u >= 2) & (u < 3), (3 * u * u * u - 24 * u * u + 60 * u - 44) / 6)
             .when((u >= 3) & (u <= 4), (4 - u) * (4 - u) * (4 - u) / 6)
             .otherwise(F.lit(0.0)))


def with_basis(df: DataFrame, x: str, lo: str, hi: str, k: int, prefix: str = "_b") -> DataFrame:
    """Add ``k`` basis columns; the knot offsets are projected first so every
    expression stays a few nodes deep."""
    nseg = k - 3
    span = F.col(hi) - F.col(lo)
    h = F.when(span > 0, span).otherwise(F.lit(1.0)) / F.lit(float(nseg))
    u = df.withColumns({f"{prefix}u{j}": (F.col(x) - (F.col(lo) + F.lit(float(j - 3)) * h)) / h
                        for j in range(k)})
    return u.withColumns({f"{prefix}{j}": _cardinal_cubic(F.col(f"{prefix}u{j}")) for j in range(k)}) \
            .drop(*[f"{prefix}u{j}" for j in range(k)])


def _fitter(series: list[str], names: list[str], k: int, lambdas: tuple[float, ...], mode: str,
            center: tuple[float, ...] | None = None):
    """The function of step 3; it refers to nothing outside itself, so workers need no package.

    ``mode`` is ``"series"`` (choose by each series' own score), ``"curve"``
    (the input rows with residual sum and edf of every parameter, largest
    first) or ``"given"`` (the parameter with number ``_at``; score, scale and
    residual degrees of freedom from the row).  ``center`` has the mean of
    the basis over all rows, where the level of a series is taken.
    """

    f_tail = f_tail_function()

    def fit(batches):
        import numpy as np
        import pandas as pd

        basis = np.array([[1, -3, 3, -1], [4, 0, -6, 3], [1, 3, 3, -3], [0, 0, 0, 1]]) / 6.0  # in powers of t
        difference = np.diff(np.eye(k), n=2, axis=0)
        penalty = difference.T @ difference
        grid = np.array(sorted(lambdas, reverse=True))

        for pdf in batches:
            m = len(pdf)
            g, hv, yy = np.zeros((m, k, k)), np.zeros((m, k)), pdf["yy"].to_numpy(float)
            n, mean = pdf["n"].to_numpy(float), pdf["mean"].to_numpy(float)
            lo, step = pdf["_lo"].to_numpy(float), (pdf["_hi"] - pdf["_lo"]).to_numpy(float) / (k - 3)
            line = np.zeros((m, 3))  # sums of p, p * p and p * y, where x = lo + p * step
            for i, segments in enumerate(pdf["segments"]):
                for q in segments:
                    s, t, y = int(q["seg"]), np.array(q["t"], float), np.array(q["y"], float)
                    g[i, s:s + 4, s:s + 4] += basis @ t[np.add.outer(np.arange(4), np.arange(4))] @ basis.T
                    hv[i, s:s + 4] += basis @ y
                    line[i] += (s * t[0] + t[1], s * s * t[0] + 2 * s * t[1] + t[2], s * y[0] + y[1])
            # the straight line, which is also the result of a series too short for a spline
            sp, spp, spy = line.T
            spread = spp - sp * sp / n
            sloped = spread > 1e-12 * np.maximum(spp, 1)
            rise = np.where(sloped, spy / np.where(sloped, spread, 1.0), 0.0)
            base = -rise * sp / n
            line_rss = np.maximum(yy - rise * spy, 0.0)

            # q' (g + penalty) q = 1 and q' penalty q = diag(bend): all parameters share the basis q
            size, axes = np.linalg.eigh(g + penalty)
            solid = sloped & (size[:, 0] > 1e-13 * size[:, -1])
            axes = axes / np.sqrt(np.where(solid[:, None], size, 1.0))[:, None, :]
            bend, turn = np.linalg.eigh(np.swapaxes(axes, 1, 2) @ penalty @ axes)
            bend, q = np.clip(bend, 0.0, 1.0), axes @ turn
            z = np.einsum("nij,ni->nj", q, hv)

            def solve(value):
                """(residual sum, edf, sum of b * h, divisors) for a penalty per series."""
                d = 1 - bend + value[:, None] * bend
                hit = (z * z / d).sum(1)
                left = np.maximum(yy - 2 * hit + (z * z * (1 - bend) / (d * d)).sum(1), 0.0)
                return left, ((1 - bend) / d).sum(1), hit, d

            if mode == "curve":
                curve = [solve(np.full(m, value)) for value in grid]
                # without a slope every parameter gives the constant
                left = np.array([np.where(solid, c[0], line_rss) for c in curve]).reshape(len(grid), m)
                freedom = np.array([np.where(solid, c[1], np.where(sloped, 2.0, 1.0)) for c in curve]).reshape(len(grid), m)
                out = pdf.assign(_rss=list(left.T), _edf=list(freedom.T))
                yield out[names]
                continue

            if mode == "series":
                def score(value):
                    left, freedom, _, _ = solve(value)
                    room = n - freedom
                    fine = solid & (room > 0.5)
                    return np.where(fine, n * left / np.where(fine, room, 1.0) ** 2, np.inf)

                scores = np.array([score(np.full(m, value)) for value in grid])
                # scores that differ by less than a millionth are ties, which go to the larger penalty
                chosen = np.argmax(scores * (1 - 1e-6) <= scores.min(axis=0), axis=0)
                gcv = scores.min(axis=0) if not m else scores[chosen, np.arange(m)]
                fits = np.isfinite(gcv)
            else:
                chosen, gcv, fits = pdf["_at"].to_numpy(int), pdf["_gcv"].to_numpy(float), solid
            left, freedom, hit, d = solve(grid[chosen])
            edf = np.where(fits, freedom, np.where(sloped, 2.0, 1.0))
            rss = np.where(fits, left, line_rss)
            b = np.einsum("nij,nj->ni", q, z / d)
            beta = np.where(fits[:, None], b, base[:, None] + rise[:, None] * (np.arange(k) - 1.0))
            slope = np.where(step > 0, rise / np.where(step > 0, step, 1.0), 0.0)
            out = pdf[series].copy()
            out["n"], out["edf"] = pdf["n"], edf
            out["lambda"], out["gcv"] = np.where(fits, grid[chosen], np.nan), np.where(fits | (mode == "given"), gcv, np.nan)
            out["r2"] = np.where(yy > 0, 1 - rss / np.where(yy > 0, yy, 1.0), np.nan)
            room = n - edf if mode == "series" else pdf["_room"].to_numpy(float)
            scale = (np.where(room > 0.5, rss / np.maximum(room, 0.5), np.nan) if mode == "series"
                     else pdf["_scale"].to_numpy(float))
            out["scale"] = scale
            own = n - edf > 0.5
            out["r2_adjusted"] = np.where(own & (yy > 0) & (n > 1), 1 - rss / np.maximum(n - edf, 0.5) * np.maximum(n - 1, 1)
                                          / np.where(yy > 0, yy, 1.0), np.nan)
            # Wald test that the smooth is 0: b' (covariance)^-1 b is a sum of squares weighted by the shares of
            # the degrees of freedom, referred to F by its first two moments; the constant is not part of it
            first = np.where(fits, edf, np.where(sloped, 2.0, 1.0)) - 1
            second = np.where(fits, (((1 - bend) / d) ** 2).sum(1), np.where(sloped, 2.0, 1.0)) - 1
            tested = (room > 0.5) & (first > 1e-9) & (second > 1e-9) & (scale > 1e-12 * yy / n)
            some = lambda v, other=1.0: np.where(tested, v, other)
            out["ref_df"] = some(first * first / some(second), np.nan)
            f = np.where(fits, hit, yy - line_rss) / (some(scale) * some(first))
            out["f"] = some(f, np.nan)
            d1, d2, f = some(first * first / some(second)), some(room), some(np.maximum(f, 0.0))
            out["p"] = some(f_tail(f, d1, d2), np.nan)
            out["intercept"], out["slope"] = mean + base - slope * lo, slope
            out["slope_se"] = np.where(sloped & (n > 2), np.sqrt(
                line_rss / np.maximum(n - 2, 1) / np.where(sloped, spread, 1.0)) / np.where(step > 0, step, 1.0), np.nan)
            out["x_min"], out["x_max"] = pdf["x_min"], pdf["x_max"]
            out["coefficients"] = list(beta + mean[:, None])
            if center is not None:
                at = np.array(center)
                out["level"] = mean + np.where(fits, b @ at, 0.0 if not m else np.where(sloped, beta @ at, 0.0))
                spread_at = (np.einsum("nij,i->nj", q, at) ** 2 / d).sum(1)
                out["level_se"] = np.sqrt(scale * np.where(fits, spread_at, 1 / n))
                out["_rss"], out["_yy"], out["_mean"] = rss, yy, mean
            out["_lo"], out["_hi"] = pdf["_lo"], pdf["_hi"]
            yield out[names].astype(object).where(lambda f: f.notna(), None) if m else pd.DataFrame(columns=names)

    return fit


def _sums(df: DataFrame, x: str, y: str, series: list[str], k: int, whole: bool) -> DataFrame:
    """Step 2: one row per series, with the sums of its segments; ``whole`` leaves out rows without a key."""
    src = df.select(*series, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")) \
            .filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    for c in series if whole else ():
        src = src.filter(F.col(c).isNotNull())
    rng = src.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("r")).scalar()
    means = src.groupBy(*series).agg(F.avg("_y").alias("mean"))
    nseg = k - 3
    src = _null_safe_join(src, means, series, "inner").withColumns({"_lo": rng.getField("lo"), "_hi": rng.getField("hi")})
    pos = F.when(F.col("_hi") > F.col("_lo"), (F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * nseg).otherwise(0.0)
    src = src.withColumn("_p", pos).withColumn("_seg", F.least(F.floor("_p"), F.lit(nseg - 1)).cast("int"))
    src = src.withColumns({"_t": F.col("_p") - F.col("_seg"), "_c": F.col("_y") - F.col("mean")})
    power = lambda e: F.lit(1.0) if e == 0 else F.pow("_t", F.lit(float(e)))
    sums = src.groupBy(*series, "mean", "_lo", "_hi", "_seg").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_c") * F.col("_c")).alias("yy"),
        F.min("_x").alias("x_min"), F.max("_x").alias("x_max"),
        F.array(*[F.sum(power(e)) for e in range(7)]).alias("t"),
        F.array(*[F.sum(F.col("_c") * power(e)) for e in range(4)]).alias("y"))
    return sums.groupBy(*series, "mean", "_lo", "_hi").agg(
        F.sum("n").alias("n"), F.sum("yy").alias("yy"), F.min("x_min").alias("x_min"), F.max("x_max").alias("x_max"),
        F.collect_list(F.struct(F.col("_seg").alias("seg"), "t", "y")).alias("segments"))  # k - 3 at most


def _chosen(price: float) -> Column:
    """The number of the parameter with the least ``rss + price * edf``; near ties go to the larger penalty."""
    cost = F.zip_with("_rss", "_edf", lambda r, e: r + F.lit(price) * e)
    near = F.transform(cost, lambda c: c * (1 - 1e-6) <= F.array_min(cost))
    return (F.array_position(near, True) - 1).cast("int")


def joint_price(curves: DataFrame) -> tuple[float, float, float, float]:
    """``(price, N, RSS, EDF)`` that make ``N * RSS / (N - EDF) ** 2`` least over one parameter per series.

    At the minimum every series minimises ``rss + price * edf`` for one common
    ``price = 2 * RSS / (N - EDF)``.  A first aggregate tries 25 prices around
    the overall variance; from the best one, each further aggregate sums what
    the series choose at the price that follows from the last sums.  The root of
    the score is a ratio with a concave numerator, so each of these steps
    lowers it, and on a finite grid they end.  Every step returns two sums per
    price; the series stay where they are.
    """
    total, yy = curves.agg(F.sum("n"), F.sum("yy")).first()
    total, yy = float(total or 0), float(yy or 0)

    def sums(prices: list[float]) -> list[tuple[float, float, float, float]]:
        """(score, price, RSS, EDF) for each price, from one aggregate."""
        at = curves.select("_rss", "_edf", *[_chosen(v).alias(f"_i{j}") for j, v in enumerate(prices)])
        row = at.agg(*[F.sum(F.get(c, f"_i{j}")) for j in range(len(prices)) for c in ("_rss", "_edf")]).first()
        out = []
        for j, price in enumerate(prices):
            rss, edf = (float(v or 0) for v in row[2 * j:2 * j + 2])
            out.append((total * rss / (total - edf) ** 2 if total - edf > 0.5 else float("inf"), price, rss, edf))
        return out

    if not total:
        return 0.0, 0.0, 0.0, 0.0
    best = min(sums([yy / total * 10 ** (e / 4) for e in range(12, -13, -1)]), key=lambda s: s[0])
    while best[0] < float("inf"):
        after = sums([2 * best[2] / (total - best[3])])[0]
        if not after[0] < best[0] * (1 - 1e-9):
            break
        best = after
    return best[1], total, best[2], best[3]


def _center(curves: DataFrame, k: int) -> tuple[float, ...]:
    """The mean of the basis over all rows, from the sums of the segments (k - 3 of them)."""
    seg = curves.select(F.explode("segments").alias("q")).groupBy("q.seg").agg(*[F.sum(F.get("q.t", F.lit(e))).alias(f"t{e}") for e in range(4)])
    basis = np.array([[1, -3, 3, -1], [4, 0, -6, 3], [1, 3, 3, -3], [0, 0, 0, 1]]) / 6.0
    out, n = np.zeros(k), 0.0
    for row in seg.collect():
        t = np.array(row[1:], float)
        out[row.seg:row.seg + 4] += basis @ t
        n += t[0]
    return tuple(float(v) for v in out / max(n, 1.0))


def smooth_trend(df: DataFrame, x: str, y: str, series: Sequence[str], k: int = 10, criterion: str = "series") -> DataFrame:
    """One penalised spline and one straight line per series.

    Output: the series keys, ``n``, ``edf``, ``lambda``, ``gcv``, ``r2`` (deviance
    explained), ``scale`` (residual variance), ``r2_adjusted``, the test that
    the smooth is 0 (``f``, ``ref_df``, ``p``), ``intercept``, ``slope`` and ``slope_se`` of
    the line, ``x_min``, ``x_max`` and ``coefficients`` (array of ``k``
    doubles); pass it to :func:`fitted_values` for the fitted curve.

    By the criterion ``"series"`` only fits with ``edf < n - 0.5`` are
    considered, so a short series never interpolates its points; a series
    without such a fit gets its straight line (a constant if it has one ``x``)
    and NULL ``lambda`` and ``gcv``.

    By ``"joint"`` the series are the cells of one model: rows without a key are
    left out, as a model frame does, ``gcv`` and ``scale`` are the model's, a
    short series may take as many degrees of freedom as the joint score
    pays for, and ``level`` and ``level_se`` are added (the mean of the series'
    curve over all rows of the model: its intercept when smooths sum to 0).
    """
    series = list(series)
    if criterion not in ("series", "joint"):
        raise ValueError(f"unknown criterion {criterion!r}")
    joint = criterion == "joint"
    rows, center = _sums(df, x, y, series, k, joint), None
    if joint:
        kept = T.StructType([*rows.schema.fields, *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("_rss", "_edf")]])
        curves = stored(rows.mapInPandas(_fitter(series, kept.fieldNames(), k, LAMBDAS, "curve"), kept), "curves")
        price, total, rss, edf = joint_price(curves)
        room, center = total - edf, _center(curves, k)
        one = lambda v: F.lit(float(v) if v is not None else None).cast("double")
        rows = curves.withColumns({
            "_at": _chosen(price), "_gcv": one(total * rss / room ** 2 if room > 0.5 else None),
            "_scale": one(rss / room if room > 0.5 else None), "_room": one(room)}).drop("_rss", "_edf")

    doubles = ["edf", "lambda", "gcv", "r2", "scale", "r2_adjusted", "f", "ref_df", "p", "intercept", "slope", "slope_se", "x_min", "x_max"]
    out_schema = T.StructType(
        [f for f in rows.schema.fields if f.name in series] + [T.StructField("n", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in doubles]
        + [T.StructField("coefficients", T.ArrayType(T.DoubleType()))]
        + [T.StructField(c, T.DoubleType()) for c in (("level", "level_se", "_rss", "_yy", "_mean") if joint else ())]
        + [T.StructField("_lo", T.DoubleType()), T.StructField("_hi", T.DoubleType())])
    return rows.mapInPandas(_fitter(series, out_schema.fieldNames(), k, LAMBDAS, "given" if joint else "series", center), out_schema)


def model_summary(models: DataFrame) -> DataFrame:
    """One row for a joint fit: ``terms``, ``n``, ``edf``, ``gcv``, ``scale``, ``r2_adjusted`` and ``deviance_explained``.

    Both shares refer to the variance about the mean of all rows.
    """
    whole = models.agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("n"), F.sum("edf").alias("edf"), F.first("gcv").alias("gcv"),
                       F.first("scale").alias("scale"), F.sum("_rss").alias("rss"), F.sum(F.col("n") * F.col("_mean")).alias("s"),
                       F.sum(F.col("_yy") + F.col("n") * F.col("_mean") * F.col("_mean")).alias("ss"))
    spread = F.col("ss") - F.col("s") * F.col("s") / F.col("n")
    return whole.select("terms", "n", "edf", "gcv", "scale",
                        F.when((spread > 0) & (F.col("n") > 1), 1 - F.col("scale") * (F.col("n") - 1) / spread).alias("r2_adjusted"),
                        F.when(spread > 0, 1 - F.col("rss") / spread).alias("deviance_explained"))


def fitted_values(df: DataFrame, models: DataFrame, x: str, series: Sequence[str],
                  k: int = 10, out: str = "fitted") -> DataFrame:
    """Evaluate each series' spline at its rows; NULL where ``x`` is NULL.

    The models (one row per series) are fitted once and stored.
    """
    m = stored(models.select(*series, "coefficients", "_lo", "_hi"), "models")
    j = _null_safe_join(df, m, list(series), "left").withColumn("_fx", F.col(x).cast("double"))
    j = with_basis(j, "_fx", "_lo", "_hi", k, prefix="_fb")
    fitted = None
    for i in range(k):
        term = F.col("coefficients")[i] * F.col(f"_fb{i}")
        fitted = term if fitted is None else fitted + term
    return (j.withColumn(out, F.when(F.col("_fx").isNotNull(), fitted))
             .drop("coefficients", "_lo", "_hi", "_fx", *[f"_fb{i}" for i in range(k)]))
