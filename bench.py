"""Wall seconds of the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Every query runs to completion (all rows computed, nothing collected).  A first small query starts
the JVM and is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from firegrid.plans.queries import REGISTRY
from firegrid.session import drop_scratch

HEADLINE = [
    "prep_points", "tile_counts", "density_grid", "adjacency_pairs", "cluster_aggressive", "cluster_conservative", "tree_cover",
    "burned_areas", "skim_points", "zonal_lct_hist", "zonal_vcf_mean", "zonal_region", "processed_fires",
    "emission_totals", "emit_base", "speciate_mozart", "global_totals", "reject_counts",
    "grid_daily_1x1", "grid_monthly_0p9x1p25", "grid_wrf_lambert", "grid_unstructured",
    "regrid_average", "v1_overlap", "v1_emissions", "diff_outputs", "compare_totals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("firegrid-bench")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="firegrid-bench-"))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["distinct_dates"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        drop_scratch(spark)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
