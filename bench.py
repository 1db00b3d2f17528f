"""Headline benchmark: build the layers, then run every analytical query on stored gold.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the input and the local cores.
Each query is collected once, without a warm-up run of its own.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.lake import Lake  # noqa: E402
from stratalake.plans import marts, runner  # noqa: E402
from stratalake.plans.frames import Star  # noqa: E402
from stratalake.schemas import RAW_ENTITIES  # noqa: E402
from stratalake.session import build_session, profile, scratch_folder  # noqa: E402
from stratalake.sources.layers import read_gold  # noqa: E402
from stratalake.sources.raw import join_path  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        extra={"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
               "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_folder(spark)
    raw, bronze, silver, gold = (
        join_path(root, name) for name in ("raw", "bronze", "silver", "gold"))
    seconds: dict[str, float] = {}

    def timed(name: str, work: Callable[[], object]) -> None:
        begun = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - begun, 3)

    lake = Lake(spark, sf_dir)
    # The test tables are one row group each; spread the input over the cores as a lake would.
    timed("prepare_raw", lambda: [
        lake.deliver(name, raw, int(cpus)) for name in RAW_ENTITIES])
    timed("build_bronze", lambda: runner.raw_to_bronze(spark, raw, bronze))
    timed("build_silver", lambda: runner.bronze_to_silver(spark, bronze, silver))
    timed("build_gold", lambda: runner.silver_to_gold(spark, silver, gold))
    timed("quality_checks", lambda: runner.quality_checks(spark, silver, gold).collect())

    star = Star(read_gold(spark, gold))
    for name, build in (
        ("k1_revenue_by_category", marts.revenue_by_category),
        ("k2_revenue_by_month", marts.revenue_by_month),
        ("k3_top_customers", marts.top_customers),
        ("k4_campaign_performance", marts.campaign_performance),
        ("k5_events_by_channel", marts.events_by_channel),
    ):
        timed(name, lambda build=build: build(star).collect())
    # A mart as large as its dimensions make it: written, not brought to the driver.
    timed("k6_dm_sales_overview",
          lambda: marts.sales_overview(star).write.format("noop").mode("overwrite").save())
    for number, name in enumerate(marts.tuned_queries(star), start=7):
        timed(f"k{number}_tuned_{name}", lambda n=name: marts.tuned_queries(star)[n].collect())
    with profile(spark, "naive"):
        for number, name in enumerate(marts.naive_queries(star), start=7):
            timed(f"k{number}_naive_{name}", lambda n=name: marts.naive_queries(star)[n].collect())

    headline = [n for n in seconds if "_naive_" not in n and not n.startswith("prepare_")]
    print(json.dumps({
        "metric": "layer builds plus k1-k10, wall clock",
        "value": round(sum(seconds[name] for name in headline), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
