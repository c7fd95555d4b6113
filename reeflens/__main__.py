"""Run the whole analysis: ``python -m reeflens --historic H --current C --comm-sp S
--traits T --lats L --out DIR [--results name,name]``.

Reads the two survey exports (Parquet or CSV), the three lookups, applies the
original analysis' profile and writes every named result and chart table as
Parquet under ``--out``.  Submit with ``spark-submit`` on a cluster; set
``spark.checkpoint.dir`` to a shared folder there.
"""

from __future__ import annotations

import argparse

from .functions.names import with_clean_names
from .plans.profile import REFERENCE
from .plans.report import RESULTS, Analysis, write_results
from .session import get_session
from .sources.survey import load_survey, load_traits, read_table


def main(argv: list[str] | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="reeflens", description=__doc__.split("\n\n")[0])
    ap.add_argument("--historic", required=True, help="historic survey export")
    ap.add_argument("--current", required=True, help="current survey export")
    ap.add_argument("--comm-sp", required=True, help="species -> commercial lookup")
    ap.add_argument("--traits", required=True, help="species traits lookup (group_traits)")
    ap.add_argument("--lats", required=True, help="region -> latitude lookup")
    ap.add_argument("--out", required=True, help="output folder for result tables")
    ap.add_argument("--results", default=None, help="comma-separated subset of results")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    p = REFERENCE
    survey = load_survey(spark, args.historic, args.current, p.historic_excluded_families)
    analysis = Analysis(survey, with_clean_names(read_table(spark, args.comm_sp)),
                        load_traits(spark, args.traits),
                        with_clean_names(read_table(spark, args.lats)), p)
    names = args.results.split(",") if args.results else list(RESULTS)
    paths = write_results(analysis, args.out, names)
    for name, path in paths.items():
        print(f"{name}\t{path}")
    return paths


if __name__ == "__main__":
    main()
