"""Plan properties of the registered queries (sf0.001 test tables), including the tables they store on the way."""

import contextlib
import io
import re
from collections import Counter

import pytest

from reeflens.operators import outliers, sites, smooth, wide
from reeflens.plans import catalog, report
from reeflens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
        df.explain(mode="formatted")
    return buf.getvalue()


@contextlib.contextmanager
def recorded():
    """Stored tables as (name, plan) while the block runs."""
    seen, kept = [], {}
    for module in (outliers, sites, smooth, wide, report):
        kept[module] = real = module.stored

        def record(df, name, real=real):
            seen.append((name, _plan(df)))
            return real(df, name)

        module.stored = record
    try:
        yield seen
    finally:
        for module, real in kept.items():
            module.stored = real


@pytest.fixture(scope="module")
def plans(spark):
    """Per query: its final plan first, then those of the tables it stored."""
    out = {}
    for name, fn in QUERIES.items():
        with recorded() as seen:
            final = _plan(fn(spark, SF))
        out[name] = [final, *[p for _, p in seen]]
    return out


def test_no_cartesian_products(plans):
    for name, ps in plans.items():
        for p in ps:
            assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_no_python_outside_smoothing(plans):
    for name, ps in plans.items():
        if name.startswith("coral_trend_") and not name.endswith("_linear"):  # fits and their tests
            assert any("MapInPandas" in p for p in ps), name
            continue
        for node in PYTHON_NODES:
            assert all(node not in p for p in ps), (name, node)


def test_no_percentile_buffers_and_no_hints(plans):
    for name, ps in plans.items():
        for p in ps:
            assert "percentile(" not in p and "ResolvedHint" not in p and "UnresolvedHint" not in p, name


def test_top_k_uses_window_group_limit(plans):
    for name in ("top_fish_north_3p", "top_inv_south"):
        assert "WindowGroupLimit" in plans[name][0], name


def test_label_filter_reaches_the_scan(plans):
    assert any("EqualTo(o_orderstatus,F)" in p for p in plans["fish_productivity"])


def test_scans_are_pruned(plans):
    p = plans["shannon_by_transect"][0].split("== Physical Plan ==")[-1]
    # lineitem is read with the used columns only
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double" in p
    assert "l_shipdate" not in p and "l_comment" not in p


def test_mixed_grain_reads_the_stem_once(plans):
    physical = plans["biomass_raw"][0].split("== Physical Plan ==")[-1]
    assert len(re.findall(r"\n\(\d+\) Scan parquet", physical)) == 1


def test_shannon_has_no_window(plans):
    for name in ("shannon_by_transect", "shannon_by_transect_matrix"):
        assert "Window" not in plans[name][0].split("== Physical Plan ==")[-1]


def test_stems_are_stored_once_for_all_results(spark, tmp_path):
    with recorded() as seen:
        a = catalog.analysis(spark, SF)
        report.write_results(a, str(tmp_path), [
            "fish_productivity", "biomass_raw", "biomass_by_region", "fish_species_reef", "top_fish_north_2p",
            "top_fish_south_2p", "top_fish_north_3p", "coral_reef", "echinoderm_reef", "invertebrates_by_region"])
    assert Counter(n for n, _ in seen) == {"fish": 1, "sizes": 1, "quartiles": 1, "invertebrates": 1, "species": 1, "sites": 4}
