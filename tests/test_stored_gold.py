"""Layers written by the runner from the test tables, checked against DuckDB."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.lake import Lake
from checks.queries import ALL_RULES_SQL, MART_SQL, ORACLES, comparable
from checks.duck import with_ctes
from checks.raw_entities import RAW_SQL
from stratalake.operators import quality
from stratalake.plans import marts, runner
from stratalake.plans.frames import Star
from stratalake.sources import catalog
from stratalake.sources.layers import read_gold
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    paths = {name: str(root / name) for name in ("bronze", "silver", "gold", "serving")}
    lake = Lake(spark, SF_DIR)
    for name in RAW_SQL:
        lake.bronze(name).repartition(3).write.parquet(f"{paths['bronze']}/{name}")
    runner.bronze_to_silver(spark, paths["bronze"], paths["silver"])
    runner.silver_to_gold(spark, paths["silver"], paths["gold"])
    return paths


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


STORED = {
    "k1_revenue_by_category": marts.revenue_by_category,
    "k2_revenue_by_month": marts.revenue_by_month,
    "k3_top_customers": marts.top_customers,
    "k4_campaign_performance": marts.campaign_performance,
    "k5_events_by_channel": marts.events_by_channel,
    "k6_dm_sales_overview": marts.sales_overview,
    "k7_bench_revenue_by_category": lambda s: marts.tuned_queries(s)["revenue_by_category"],
    "k8_bench_revenue_by_month": lambda s: marts.tuned_queries(s)["revenue_by_month"],
    "k9_bench_revenue_by_campaign": lambda s: marts.tuned_queries(s)["revenue_by_campaign"],
    "k10_bench_top_customers": lambda s: marts.tuned_queries(s)["top_customers"],
}


@pytest.mark.parametrize("broadcasts", [True, False])
def test_marts_on_stored_gold(spark, duck, roots, broadcasts):
    star = Star(read_gold(spark, roots["gold"]))
    if not broadcasts:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, build in STORED.items():
            found = differences(spark, duck, SF_DIR, lambda *_, b=build: comparable(b(star)),
                                ORACLES[name])
            assert found is None, name
    finally:
        if not broadcasts:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 2**20))


def test_mart_view(spark, duck, roots):
    catalog.publish_gold(spark, roots["gold"])
    view = catalog.publish_mart_view(spark)
    assert differences(spark, duck, SF_DIR, lambda *_: comparable(spark.table(view)),
                       with_ctes(MART_SQL)) is None


def test_quality_on_stored_layers(spark, duck, roots):
    results = runner.quality_checks(spark, roots["silver"], roots["gold"])
    base = [rule.name for rule in (*quality.SILVER_RULES, *quality.GOLD_RULES)]
    results = results.where(F.col("rule_name").isin(base)).drop("description", "severity")
    assert differences(spark, duck, SF_DIR, lambda *_: results, with_ctes(ALL_RULES_SQL)) is None


def test_rerun_gives_the_same_rows(spark, roots):
    before = {name: df.collect() for name, df in read_gold(spark, roots["gold"]).items()}
    runner.silver_to_gold(spark, roots["silver"], roots["gold"])
    for name, df in read_gold(spark, roots["gold"]).items():
        assert sorted(df.collect(), key=str) == sorted(before[name], key=str), name
