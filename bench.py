"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Building the
star and cleaning the messy tables are timed as their own entries; the analyses then
read the staged star, as they do in production.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from tillcheck.registry import all_queries
from tillwise.catalog import ANALYSES
from tillwise.model import TABLES
from tillwise.operators.frames import FRAMES
from tillwise.sources.star import benchmark_star

OTHERS = (
    "measure_by_company",
    "measure_by_segment_province",
    "measure_return_rate",
    "measure_inventory_turnover_measure",
    "measure_ytd_revenue",
    "product_ranking",
    "stockout_matrix",
    "enrichment_check",
    "date_dimension",
    "densify_grid",
    "clean_all",  # the first to ask for the cleaned tables, so it carries their cost
    "cleaning_summary",
    "validate_all_clean",
    "validate_all",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillwise-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillwise-shared-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads

    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    def build() -> None:
        star = benchmark_star(spark, sf_dir)
        for name in TABLES:
            star.table(name)

    timed("build_star", build)
    queries = all_queries()
    for name in (*ANALYSES, *FRAMES, *OTHERS):
        # The noop sink runs the whole plan without shipping rows to Python.
        timed(
            name,
            lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save(),
        )
    folder = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    scale = float(folder) if folder.replace(".", "", 1).isdigit() else folder
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale,
            }
        )
    )


if __name__ == "__main__":
    main()
