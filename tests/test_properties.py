
import math
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from reeflens.operators.diversity import shannon
from reeflens.operators.ranking import group_totals, top_n_ties
from reeflens.operators.sites import consistent_sites

SETTINGS = settings(max_examples=8, deadline=None)

site_rows = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(["r1", "r2", "r3", "r4"]),
              st.integers(min_value=2000, max_value=2012)),
    min_size=1, max_size=40)


def _sites(spark, rows):
    return spark.createDataFrame(rows, "region string, reef string, year int")


@SETTINGS
@given(rows=site_rows, t=st.integers(min_value=1, max_value=6))
def test_explicit_threshold_is_idempotent(spark, rows, t):
    once = consistent_sites(_sites(spark, rows), min_years=t, materialize=False).data
    twice = consistent_sites(once, min_years=t, materialize=False).data
    assert sorted(once.collect()) == sorted(twice.collect())
    # brute force
    years = defaultdict(set)
    for r, f, y in rows:
        years[(r, f)].add(y)
    expect = sorted(x for x in rows if len(years[(x[0], x[1])]) >= t)
    assert sorted(tuple(r) for r in once.collect()) == expect


@SETTINGS
@given(rows=site_rows)
def test_every_region_keeps_a_site_unless_ceil_trap(spark, rows):
    sel = consistent_sites(_sites(spark, rows), materialize=False)
    thr = sel.summary.collect()[0]["threshold"]
    years = defaultdict(set)
    for r, f, y in rows:
        years[(r, f)].add(y)
    total = len({y for _, _, y in rows})
    best = defaultdict(int)
    for (r, _), ys in years.items():
        best[r] = max(best[r], len(ys))
    k = min(best.values())
    assert thr == math.ceil((k / total) * total)
    kept_regions = {r["region"] for r in sel.data.collect()}
    if thr == k:
        assert kept_regions == set(best)


@SETTINGS
@given(q=st.lists(st.lists(st.integers(min_value=0, max_value=9), min_size=1, max_size=6),
                  min_size=1, max_size=4))
def test_shannon_bounds(spark, q):
    rows = [("R", f"u{i}", 1, f"s{j}", float(v)) for i, unit in enumerate(q) for j, v in enumerate(unit)]
    df = spark.createDataFrame(rows, "region string, reef string, transect int, species string, quantity double")
    h = {r["reef"]: r["shannon_index"] for r in shannon(df).collect()}
    for i, unit in enumerate(q):
        s = sum(1 for v in unit if v > 0)
        assert -1e-12 <= h[f"u{i}"] <= (math.log(s) if s > 1 else 0.0) + 1e-9


@SETTINGS
@given(vals=st.lists(st.tuples(st.sampled_from(["p1", "p2"]), st.one_of(st.none(), st.integers(0, 5))),
                     min_size=1, max_size=25), k=st.integers(min_value=1, max_value=4))
def test_top_k_rows_and_shares(spark, vals, k):
    rows = [(p, f"s{i}", None if v is None else float(v)) for i, (p, v) in enumerate(vals)]
    df = spark.createDataFrame(rows, "period string, species string, v double")
    top = top_n_ties(df, k, "v", ["period"]).collect()
    for p in ("p1", "p2"):
        nonnull = sorted((r[2] for r in rows if r[0] == p and r[2] is not None), reverse=True)
        got = [r for r in top if r["period"] == p]
        assert len(got) >= min(k, len(nonnull))
        if nonnull:
            cutoff = nonnull[min(k, len(nonnull)) - 1]
            assert len(got) == sum(1 for v in nonnull if v >= cutoff)
    tot = {r["period"]: r["total"] for r in group_totals(df, "v", ["period"], "total").collect()}
    for p, t in tot.items():
        if t:
            share = sum(100 * r[2] / t for r in rows if r[0] == p and r[2] is not None)
            assert abs(share - 100) < 1e-9
