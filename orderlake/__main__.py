"""Command line: ``python -m orderlake {orders,history,lines} --root DIR --as-of TIME FILE...``"""

from __future__ import annotations

import argparse

from orderlake.plans.lines import LineLake
from orderlake.plans.orders import OrderLake
from orderlake.session import lake_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="orderlake")
    parser.add_argument("pipeline", choices=["orders", "history", "lines"])
    parser.add_argument("files", nargs="+")
    parser.add_argument("--root", required=True, help="folder of the tables, on a shared file system")
    parser.add_argument("--as-of", required=True, help="load time, e.g. '2026-06-01 00:00:00'")
    parser.add_argument("--manifest", help="expected outcomes to hold the history against")
    chosen = parser.parse_args()

    spark = lake_session()
    if chosen.pipeline == "lines":
        lake = LineLake(spark, chosen.root)
    else:
        lake = OrderLake(spark, chosen.root, keep_history=chosen.pipeline == "history")
    lake.run(chosen.files, chosen.as_of)
    lake.audit(chosen.as_of).show(100, truncate=False)
    if chosen.pipeline == "lines":
        for report in lake.skew():
            report.show(200, truncate=False)
        lake.end_run()
    if chosen.manifest:
        for name, result in lake.reconcile(chosen.manifest).items():
            print(name)
            result.show(truncate=False)
    lake.row_counts().show(truncate=False)
    lake.health().show(truncate=False)
    lake.history_log().orderBy("run_at", "table_name").show(200, truncate=False)


if __name__ == "__main__":
    main()
