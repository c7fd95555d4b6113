"""The joint criterion, the tests of the smooth terms and the parametric part against dense algebra and tabled values."""

import itertools
import math

import numpy as np
import pytest

from reeflens.operators.contrasts import parametric_terms
from reeflens.operators.smooth import LAMBDAS, model_summary, smooth_trend
from reeflens.operators.tails import f_tail_function

K = 8
KEYS = ["a", "b"]


def points(cells, n=24, seed=3):
    """Rows (a, b, x, y): a wave, a line and noise by cell."""
    rnd = np.random.default_rng(seed)
    shapes = [lambda x: 4 * np.sin(x / 2), lambda x: 0.5 * x, lambda x: 0 * x, lambda x: (x / 8) ** 2]
    return [(a, b, float(x), round(10 * i + float(shapes[i % 4](x)) + float(rnd.normal(0, (0.3, 1.0, 2.0)[i % 3])), 3))
            for i, (a, b) in enumerate(cells) for x in range(n - 3 * i)]


def basis(x, lo, hi):
    p = (np.asarray(x, float) - lo) / (hi - lo) * (K - 3)
    seg = np.minimum(np.floor(p), K - 4).astype(int)
    t, out = p - seg, np.zeros((len(p), K))
    for row, (s, u) in enumerate(zip(seg, t)):
        out[row, s:s + 4] = [(1 - u) ** 3 / 6, (3 * u ** 3 - 6 * u * u + 4) / 6, (-3 * u ** 3 + 3 * u * u + 3 * u + 1) / 6, u ** 3 / 6]
    return out


def penalty():
    d = np.diff(np.eye(K), n=2, axis=0)
    return d.T @ d


def curves(rows, cells):
    """{cell: [(rss, edf) by parameter]} from one dense solve each."""
    lo, hi = min(r[2] for r in rows), max(r[2] for r in rows)
    out = {}
    for c in cells:
        x, y = (np.array([r[i] for r in rows if r[:2] == c]) for i in (2, 3))
        b = basis(x, lo, hi)
        out[c] = []
        for lam in sorted(LAMBDAS, reverse=True):
            inverse = np.linalg.inv(b.T @ b + lam * penalty())
            out[c].append((float(((y - b @ inverse @ b.T @ y) ** 2).sum()), float(np.trace(inverse @ b.T @ b))))
    return out


CELLS = [("n", "u"), ("n", "v"), ("s", "u")]


@pytest.fixture(scope="module")
def rows_of_cells():
    return points(CELLS)


def frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, x double, y double")


def test_joint_score_is_the_least_of_all_choices(spark, rows_of_cells):
    models = smooth_trend(frame(spark, rows_of_cells), "x", "y", KEYS, K, "joint").collect()
    n, by = len(rows_of_cells), curves(rows_of_cells, CELLS)
    scores = {at: n * sum(by[c][i][0] for c, i in zip(CELLS, at)) / (n - sum(by[c][i][1] for c, i in zip(CELLS, at))) ** 2
              for at in itertools.product(range(len(LAMBDAS)), repeat=3)}
    least = min(scores.values())
    assert all(m["gcv"] == pytest.approx(least, rel=1e-5) for m in models)
    grid = sorted(LAMBDAS, reverse=True)
    chosen = tuple(grid.index(next(m["lambda"] for m in models if (m["a"], m["b"]) == c)) for c in CELLS)
    assert scores[chosen] == pytest.approx(least, rel=1e-5)


def test_joint_and_single_choice_differ(spark, rows_of_cells):
    df = frame(spark, rows_of_cells)
    one, all_ = ({(r["a"], r["b"]): r for r in smooth_trend(df, "x", "y", KEYS, K, c).collect()} for c in ("series", "joint"))
    assert any(one[c]["lambda"] != all_[c]["lambda"] for c in CELLS)
    assert len({r["scale"] for r in all_.values()}) == 1 and len({r["scale"] for r in one.values()}) == 3
    by = curves(rows_of_cells, CELLS)
    for c, fits in by.items():  # the single choice is the least of its own scores
        n = sum(r[:2] == c for r in rows_of_cells)
        assert one[c]["gcv"] == pytest.approx(min(n * rss / (n - edf) ** 2 for rss, edf in fits), rel=1e-5)
    with pytest.raises(ValueError):
        smooth_trend(df, "x", "y", KEYS, K, "other")


def dense(rows, cells, models):
    """Estimates and errors of the bordered normal equations over all cells at once."""
    lo, hi = min(r[2] for r in rows), max(r[2] for r in rows)
    every = basis([r[2] for r in rows], lo, hi)
    center = every.mean(axis=0)
    a0, b0 = min(c[0] for c in cells), min(c[1] for c in cells)
    terms = [("(Intercept)", lambda c: True)]
    terms += [(f"a[{a}]", lambda c, a=a: c[0] == a) for a in sorted({c[0] for c in cells} - {a0})]
    terms += [(f"b[{b}]", lambda c, b=b: c[1] == b) for b in sorted({c[1] for c in cells} - {b0})]
    terms += [(f"a[{a}]:b[{b}]", lambda c, a=a, b=b: c == (a, b)) for a, b in sorted(cells) if a != a0 and b != b0]
    width = len(terms) + K * len(cells)
    x, s = np.zeros((len(rows), width)), np.zeros((width, width))
    for j, (_, holds) in enumerate(terms):
        x[:, j] = [holds(r[:2]) for r in rows]
    for i, c in enumerate(cells):
        at = slice(len(terms) + K * i, len(terms) + K * (i + 1))
        inside = np.array([r[:2] == c for r in rows])
        x[inside, at] = (every - center)[inside]  # smooths sum to 0 over all rows
        s[at, at] = models[c]["lambda"] * penalty()
    inverse = np.linalg.pinv(x.T @ x + s, rcond=1e-12, hermitian=True)
    beta, scale = inverse @ x.T @ np.array([r[3] for r in rows]), models[cells[0]]["scale"]
    return {name: (beta[j], math.sqrt(inverse[j, j] * scale)) for j, (name, _) in enumerate(terms)}


def test_terms_match_the_bordered_equations(spark):
    cells = [("n", "u"), ("n", "v"), ("s", "u"), ("s", "v"), ("w", "u"), ("w", "v")]
    rows = points(cells, 30)
    models = smooth_trend(frame(spark, rows), "x", "y", KEYS, K, "joint")
    exp = dense(rows, cells, {(m["a"], m["b"]): m for m in models.collect()})
    got = {t["term"]: t for t in parametric_terms(models, "a", "b").collect()}
    assert set(got) == set(exp) and len(got) == 6
    for name, (estimate, error) in exp.items():
        assert got[name]["estimate"] == pytest.approx(estimate, rel=1e-4, abs=1e-4)
        assert got[name]["std_error"] == pytest.approx(error, rel=1e-4)
        assert got[name]["t"] == pytest.approx(estimate / error, rel=1e-3, abs=1e-3) and 0 <= got[name]["p"] <= 1


def test_terms_without_their_cells_and_rows_without_a_key(spark, rows_of_cells):
    df = frame(spark, [*rows_of_cells, ("w", "v", 3.0, 1.0), ("w", "v", 5.0, 2.0), (None, "u", 1.0, 99.0), ("n", "u", None, 1.0), ("n", "u", 1.0, None)])
    models = smooth_trend(df, "x", "y", KEYS, K, "joint")
    assert models.count() == 4 and models.where("a is null").count() == 0
    assert smooth_trend(df, "x", "y", KEYS, K).where("a is null").count() == 1
    got = {t["term"]: t for t in parametric_terms(models, "a", "b").collect()}
    assert set(got) == {"(Intercept)", "a[s]", "a[w]", "b[v]", "a[w]:b[v]"}
    # the cell (w, u) has no rows, so its contrast and the interaction on it cannot be told
    assert got["a[w]"]["estimate"] is None and got["a[w]:b[v]"]["p"] is None and got["a[s]"]["estimate"] is not None
    nothing = smooth_trend(df.where("false"), "x", "y", KEYS, K, "joint")
    assert nothing.count() == 0 and parametric_terms(nothing, "a", "b").count() == 0


def test_f_tail_against_tables():
    f = np.array([4.9646, 3.0984, 19.2964, 161.4476, 6.6349, 0.0, 3.8415])
    d1, d2 = np.array([1, 3, 5, 1, 1, 2, 1.0]), np.array([10, 20, 2, 1, 1e6, 5, 1e6])
    assert f_tail_function()(f, d1, d2) == pytest.approx([0.05, 0.05, 0.05, 0.05, 0.01, 1.0, 0.05], abs=2e-5)


def test_test_of_a_line_is_the_test_of_its_slope(spark):
    """A penalty that leaves the line only: F is the square of the slope's t, on 1 and n - 2 degrees of freedom."""
    rnd = np.random.default_rng(1)
    rows = [("line", "u", float(x), 0.05 * x + float(rnd.normal())) for x in range(40)]
    m = smooth_trend(frame(spark, rows), "x", "y", KEYS, K).collect()[0]
    assert m["edf"] == pytest.approx(2, abs=1e-3) and m["ref_df"] == pytest.approx(1, abs=1e-2)
    assert m["f"] == pytest.approx((m["slope"] / m["slope_se"]) ** 2, rel=1e-3)
    assert m["r2_adjusted"] == pytest.approx(1 - (1 - m["r2"]) * 39 / 38, rel=1e-3)
    assert m["p"] == pytest.approx(float(f_tail_function()(np.array([m["f"]]), np.ones(1), np.array([38.0]))[0]), rel=1e-2)


def test_p_values_of_noise_are_spread_evenly(spark):
    rnd = np.random.default_rng(5)
    rows = [(str(i), "u", float(x), float(rnd.normal())) for i in range(300) for x in range(30)]
    p = sorted(m["p"] for m in smooth_trend(frame(spark, rows), "x", "y", KEYS, K).collect())
    assert 0.35 < np.mean(p) < 0.6 and 0.02 < np.mean(np.array(p) < 0.1) < 0.25  # the choice of the penalty favours small ones
    strong = [(str(i), "u", float(x), 3 * math.sin(x / 4) + float(rnd.normal())) for i in range(20) for x in range(30)]
    assert all(m["p"] < 1e-4 for m in smooth_trend(frame(spark, strong), "x", "y", KEYS, K).collect())


def test_summary_of_the_model(spark, rows_of_cells):
    models = smooth_trend(frame(spark, rows_of_cells), "x", "y", KEYS, K, "joint")
    row, cells = model_summary(models).collect()[0], models.collect()
    y = np.array([r[3] for r in rows_of_cells])
    rss, spread, n = sum(c["_rss"] for c in cells), ((y - y.mean()) ** 2).sum(), len(y)
    assert (row["terms"], row["n"]) == (3, n) and row["edf"] == pytest.approx(sum(c["edf"] for c in cells))
    assert row["scale"] == pytest.approx(rss / (n - row["edf"])) and row["gcv"] == pytest.approx(n * rss / (n - row["edf"]) ** 2)
    assert row["deviance_explained"] == pytest.approx(1 - rss / spread)
    assert row["r2_adjusted"] == pytest.approx(1 - row["scale"] * (n - 1) / spread)
