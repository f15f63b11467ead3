"""Times the pipelines, layer by layer, and the headline queries; prints one JSON line.

The line pipeline runs from delivered CSV files to the gold tables, as the
published timings do.  Writing those files from the test tables is not timed.
Queries go to a ``noop`` sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from orderlake.plans import deliveries
from orderlake.plans.catalog import QUERIES
from orderlake.plans.lines import LineLake
from orderlake.plans.orders import OrderLake
from orderlake.session import lake_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "2"))
DAY1, DAY2 = deliveries.FIRST_DAY, deliveries.SECOND_DAY

HEADLINE = ["dup_conflict_flags", "clean_orders", "gold_daily_revenue", "scd2_orders", "recon_summary",
            "dq_good", "dq_rule_counts", "scd2_lines", "gold_order_summary", "gold_region_daily",
            "skew_stats", "skew_topk"]


def clock(times: dict, name: str, work) -> object:
    start = time.perf_counter()
    result = work()
    times[name] = times.get(name, 0.0) + time.perf_counter() - start
    return result


def deliver(spark, folder: str) -> dict[str, str]:
    """Both batches of both grains as CSV files."""
    files = {}
    for day in (1, 2):
        for grain, rows in (("orders", deliveries.raw_orders(spark, SF_DIR, day)),
                            ("lines", deliveries.raw_lines(spark, SF_DIR, day))):
            files[f"{grain}{day}"] = f"{folder}/{grain}_day{day}"
            rows.repartition(int(CPUS)).write.option("header", True).csv(files[f"{grain}{day}"],
                                                                        ignoreLeadingWhiteSpace=False,
                                                                        ignoreTrailingWhiteSpace=False)
    return files


def run_lines(spark, files, root) -> tuple[dict, LineLake]:
    times: dict[str, float] = {}
    lake = LineLake(spark, root)
    for day, as_of in ((1, DAY1), (2, DAY2)):
        clock(times, "lines_bronze", lambda: lake.ingest(files[f"lines{day}"], as_of))
        good = clock(times, "lines_quality_quarantine", lambda: lake.check(as_of))
        clock(times, "lines_scd2_merge", lambda: lake.merge(good, as_of))
    clock(times, "lines_gold", lambda: lake.report(DAY2))
    clock(times, "lines_skew_audit", lambda: [report.collect() for report in lake.skew()])
    times["lines_total"] = sum(times.values())
    return times, lake


def run_orders(spark, files, root) -> dict:
    times: dict[str, float] = {}
    single = OrderLake(spark, f"{root}/single")
    clock(times, "orders_single_batch_total", lambda: single.run(files["orders1"], DAY1))
    lake = OrderLake(spark, f"{root}/history", keep_history=True)

    def both():
        lake.run(files["orders1"], DAY1)
        lake.run(files["orders2"], DAY2)

    clock(times, "orders_history_total", both)
    return times


def main() -> None:
    spark = lake_session("bench", master=f"local[{CPUS}]", spark_sql_shuffle_partitions=CPUS,
                         spark_ui_enabled="false", spark_driver_memory="16g",
                         spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="orderlake-bench-")
    files = deliver(spark, work)

    rounds = []
    for attempt in range(ROUNDS + 1):  # the first one warms the JVM up
        times, lake = run_lines(spark, files, f"{work}/run{attempt}/lines")
        times.update(run_orders(spark, files, f"{work}/run{attempt}/orders"))
        rounds.append(times)
    measured = {name: round(statistics.median(r[name] for r in rounds[1:]), 3) for name in rounds[0]}
    raw_rows = lake.bronze.read().count()

    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        measured[name] = round(min(runs), 3)

    print(json.dumps({
        "metric": "line pipeline, delivered CSV files to gold tables",
        "value": measured["lines_total"],
        "unit": "sec",
        "queries": measured,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "raw_line_rows": raw_rows,
        "raw_rows_per_sec": round(raw_rows / measured["lines_total"], 1),
        "cpus": int(CPUS),
    }))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
