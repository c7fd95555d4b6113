"""Benchmark the headline survey pipelines on the test tables.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints one JSON line.  The combined survey -- the shared stem of every
pipeline -- is derived from the test tables once and stored as Parquet
partitioned by ``label`` under the session's ``spark.checkpoint.dir`` (the
production layout: pipelines then prune by label).  The screened fish table
(Q1), which every fish pipeline starts from, is stored the same way.  Their
build times are reported as ``survey_stem`` and ``fish_stem``; every query is
then timed end to end from the stored tables with a ``noop`` sink, which
computes every row and column without moving results to the driver.  The
queries of ``FROM_RAW`` are timed from the raw tables instead.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reeflens.plans import fish  # noqa: E402
from reeflens.plans.catalog import QUERIES  # noqa: E402
from reeflens.session import ensure_checkpoint_dir, get_session  # noqa: E402
from reeflens.sources import driver_tables as dt  # noqa: E402
from reeflens.sources.survey import write_survey  # noqa: E402

HEADLINE = [
    "biomass_by_region", "biomass_by_protection", "biomass_by_functional",
    "top_fish_north_3p", "top_fish_south_2p", "coral_by_region", "coral_trend_region_linear",
    "coral_trend_region_smooth",
    "invertebrates_by_region", "inv_bars_absolute", "top_inv_south", "richness_by_region",
    "richness_history", "shannon_by_transect", "size_outliers_events",
]


#: Timed from the raw tables, stems included.
FROM_RAW = ["biomass_raw", "chart_top_fish_2p", "coral_trend_region_fitted"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE + FROM_RAW
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    extra = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="reeflens-bench-")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        # stage and task times for later inspection, written to a scratch folder
        extra |= {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = get_session(f"local[{cpus}]", parts, app_name="reeflens-bench", extra_conf=extra)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/reeflens-bench-{uuid.uuid4().hex}"
    times: dict[str, float] = {}
    # JVM warm-up (class loading, first code generation) is not query work.
    spark.range(1000).groupBy().count().collect()

    t = time.time()
    write_survey(dt.survey_view(spark, sf_dir), f"{root}/survey")
    survey = spark.read.parquet(f"{root}/survey")
    times["survey_stem"] = round(time.time() - t, 3)

    t = time.time()
    stem = fish.fish_productivity(survey, dt.commercial_lookup(spark, sf_dir),
                                  dt.trait_lookup(spark, sf_dir), dt.OBSERVATION)
    stem.write.mode("overwrite").parquet(f"{root}/fish")
    fish_stem = spark.read.parquet(f"{root}/fish")
    times["fish_stem"] = round(time.time() - t, 3)

    for name in names:
        fn = QUERIES[name]
        t = time.time()
        if getattr(fn, "uses_survey", False) and name not in FROM_RAW:
            df = fn(spark, sf_dir, survey, fish_stem)
        else:
            df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
