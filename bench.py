"""Times every query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from eventweir.plans import catalog
from eventweir.plans.workload import records
from eventweir.schemas import STREAMS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# Query → event kind whose records all pass through it, for the rows/s figures.
THROUGHPUT = {
    "d5_topup_roundtrip": "topup",
    "p1_topup_project": "topup",
    "k4_topup_sink": "topup",
    "k5_buy_sink": "buy",
    "k6_click_sink": "click",
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("eventweir-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(query: catalog.Query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    chosen = sys.argv[1:] or list(catalog.QUERIES)
    # One flow beforehand starts the JVM's and Python workers' machinery.
    run(catalog.QUERIES["k5_buy_sink"], spark, SF_DIR)
    seconds = {name: round(run(catalog.QUERIES[name], spark, SF_DIR), 3) for name in chosen}
    sizes = {kind: records(spark, SF_DIR, kind).count() for kind in STREAMS}
    rates = {name: round(sizes[kind] / seconds[name]) for name, kind in THROUGHPUT.items() if name in seconds}
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
