"""A refresh reads the items of the touched days without shuffling all others."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.lake import Lake
from stratalake.operators import joins
from stratalake.plans import refresh
from stratalake.session import settings

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def facts(spark):
    key = F.when(F.col("id") % 1000 != 0, F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(50_000).select(key.alias("k"), "id")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marks_let_all_members_pass(spark, facts):
    members = spark.range(0, 5000, 10).select(F.concat(F.lit("k"), "id").alias("k"))
    passed, exact = joins.maybe_known(facts, members, "k"), joins.keep_known(facts, members, "k")
    assert exact.exceptAll(passed).isEmpty()
    assert passed.count() < 1.2 * exact.count() and passed.columns == facts.columns


def test_a_refresh_does_not_shuffle_the_items_of_other_days(spark):
    silver = Lake(spark, SF_DIR).silver
    days = spark.sql("select date '2024-01-03' as full_date")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        part = refresh.on_days(silver, days)
        on_items = plan(part["order_items"].select("order_item_id"))
        orders = keys(part["orders"])
        items = keys(part["order_items"].join(part["orders"], "order_id", "left_semi"))
    assert "BroadcastHashJoin [__bucket" in on_items
    assert orders and items == orders & keys(silver["order_items"])


def keys(df):
    return {r.order_id for r in df.select("order_id").distinct().collect()}
