"""Joins, dedup and attribution on hot, NULL, orphan and repeated keys, and their plans."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratalake.functions import columns as c
from stratalake.operators import attribution, dedup, defects, joins, layout
from stratalake.operators.sizes import (
    auto_limit, broadcast_if_bounded, looks_small, measured_bytes, total_bytes,
)
from stratalake.plans import gold, marts
from stratalake.plans.frames import Frames, Star
from stratalake.session import NAIVE, TUNED, object_store_conf, profile, shuffle_partitions, sized


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set runtime confs for one test."""
    former = {}

    def apply(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            former.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield apply
    for name, value in former.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def small_splits(conf):
    """Thresholds low enough for AQE to treat a test-sized hot key as skew."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
         adaptive__skewJoin__skewedPartitionFactor="2.0",
         adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
         adaptive__advisoryPartitionSizeInBytes="20KB", shuffle__partitions="8")


def hot_fact(spark, rows=40_000):
    """A third of the rows share one key, a sixth have none."""
    return spark.range(0, rows, 1, 8).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 6 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_hot_key_is_split_next_to_an_aggregate(spark, conf, how):
    small_splits(conf)
    fact = hot_fact(spark)
    # The aggregate leaves the right side partitioned by k, which alone would block the split.
    members = hot_fact(spark).filter("k is not null").groupBy("k").agg(F.max("row").alias("last"))
    joined = joins.splittable_join(fact, members, ["k"], how)
    plan = final_plan(joined)
    assert "SortMergeJoin(skew=true)" in plan
    plain = fact.join(members, "k", how)
    assert "SortMergeJoin(skew=true)" not in final_plan(plain)
    assert joined.count() == plain.count()
    assert joined.exceptAll(plain.select(*joined.columns)).count() == 0


@pytest.mark.parametrize(
    ("left", "right"),
    [("int", "bigint"), ("double", "double"), ("decimal(5,1)", "decimal(7,3)"), ("date", "string")],
)
def test_keys_with_wider_equality_still_match(rows, left, right):
    value = {"int": "1", "double": "-0.0", "decimal(5,1)": "1.0", "date": "2024-01-01"}[left]
    other = {"double": "0.0"}.get(left, value)
    fact = rows("k string, v int", (value, 7)).withColumn("k", F.col("k").cast(left))
    members = rows("k string", (other,)).withColumn("k", F.col("k").cast(right))
    assert [r.v for r in joins.splittable_join(fact, members, ["k"]).collect()] == [7]


def test_null_keys_are_spread(spark, conf):
    small_splits(conf)
    fact = spark.range(0, 20_000, 1, 4).select("id", F.lit(None).cast("string").alias("k"))
    members = spark.range(0, 1000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    joined = joins.splittable_join(
        fact, members.withColumnRenamed("id", "m"), ["k"], "left"
    ).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in joined.groupBy("p").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 10_000


def test_items_and_orders_split_a_hot_order(spark, conf):
    """One order holds a third of all items; the fact join must not run it in one task."""
    small_splits(conf)
    n = 30_000
    items = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("i"), "id").alias("order_item_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("order_id"),
        F.lit("p").alias("product_id"), F.lit(1).alias("quantity"),
        F.lit(True).alias("is_quantity_valid"), F.lit(2.0).alias("gross_amount"),
        F.lit(0.0).alias("discount_amount"), F.lit(2.0).alias("net_amount"))
    orders = spark.range(0, n, 1, 8).select(
        F.col("id").cast("string").alias("order_id"), F.lit("c").alias("customer_id"),
        F.lit("2024-01-01").cast("timestamp").alias("order_date"),
        F.lit("card").alias("payment_method"), F.lit("paid").alias("order_status"),
        F.lit(True).alias("is_valid_status"))
    customers = spark.createDataFrame([("c",)], "customer_id string")
    products = spark.createDataFrame([("p",)], "product_id string")
    campaigns = spark.createDataFrame([("g",)], "campaign_id string")
    events = spark.createDataFrame(
        [("e", "c", "s", "view", dt.datetime(2024, 1, 1), "g")],
        "event_id string, customer_id string, session_id string, event_type string, "
        "event_timestamp timestamp, campaign_id string")
    fact = gold.fct_sales({"orders": orders, "order_items": items, "web_events": events},
                          customers, products, campaigns)
    plan = final_plan(fact)
    assert plan.count("SortMergeJoin(skew=true)") >= 1
    assert fact.count() == n


def test_existence_join_keeps_rows_once(rows):
    fact = rows("k string, v int", ("a", 1), ("a", 2), ("b", 3), (None, 4))
    members = rows("k string", ("a",), ("a",), (None,))
    kept = joins.keep_known(fact, members, "k")
    assert sorted(r.v for r in kept.collect()) == [1, 2]


@pytest.mark.parametrize("factor", [0, -1])
def test_replicate_rejects_a_factor_below_one(spark, factor):
    with pytest.raises(ValueError, match="at least 1"):
        joins.replicate(spark.range(2), factor)


def test_nested_columns_are_never_small(spark):
    df = spark.range(3).select("id", F.array(F.lit("x")).alias("parts"))
    assert measured_bytes(df) is None
    hinted = broadcast_if_bounded(df)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in hinted


def test_replicate_needs_no_join(spark):
    df = joins.replicate(spark.range(5), 3)
    assert Counter(r.id for r in df.collect()) == {i: 3 for i in range(5)}
    assert "Join" not in planned(df) and "Exchange" not in planned(df)


def test_latest_per_key_is_deterministic(rows):
    df = rows(
        "k string, ingestion_timestamp timestamp, v string",
        ("a", dt.datetime(2024, 1, 1), "old"), ("a", dt.datetime(2024, 1, 2), "y"),
        ("a", dt.datetime(2024, 1, 2), "x"), ("b", None, None))
    for partitions in (1, 3):
        kept = dedup.latest_per_key(df.repartition(partitions), ["k"])
        assert {(r.k, r.v) for r in kept.collect()} == {("a", "x"), ("b", None)}
    assert dedup.latest_per_key(df.select("k"), ["k"]).count() == 2


def test_dedup_limits_before_the_shuffle(spark, tmp_path):
    hot_fact(spark, 1000).write.parquet(str(tmp_path / "f"))
    df = dedup.latest_per_key(spark.read.parquet(str(tmp_path / "f")), ["k"])
    before_shuffle = planned(df).split("Exchange")[-1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_last_touch_against_brute_force(spark):
    rng = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    events = [
        (f"e{i:04d}", rng.choice(["c1"] * 5 + ["c2", "c3", None]),
         None if rng.random() < 0.1 else base + dt.timedelta(minutes=rng.randrange(0, 4320, 30)),
         rng.choice(["A", "B", "C", None]))
        for i in range(600)
    ]
    best: dict = {}
    for event_id, customer, ts, campaign in events:
        if customer is None or ts is None or campaign is None:
            continue
        key, rank = (customer, ts.date()), (ts, event_id)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, campaign)
    df = spark.createDataFrame(
        events, "event_id string, customer_id string, event_timestamp timestamp, "
                "campaign_id string")
    found = {(r.customer_id, r.sales_date): r.campaign_id
             for r in attribution.last_touch(df).collect()}
    assert found == {key: value[1] for key, value in best.items()}


def test_unknown_campaign_and_duplicate_orders(spark, rows):
    silver = {
        "orders": rows(
            "order_id string, customer_id string, order_date string, payment_method string, "
            "order_status string, is_valid_status boolean",
            ("o1", "c1", "2024-01-05 10:00:00", "card", "paid", True),
            ("o1", "c1", "2024-01-05 10:00:00", "card", "paid", True),
            ("o2", "gone", "2024-01-05 10:00:00", "card", "paid", True)),
        "order_items": rows(
            "order_item_id string, order_id string, product_id string, quantity int, "
            "gross_amount double, discount_amount double, net_amount double, "
            "is_quantity_valid boolean",
            ("i1", "o1", "p1", 1, 10.0, 1.0, 9.0, True), ("i2", "o1", "gone", 1, 1.0, 0.0, 1.0,
                                                          True),
            ("i3", "o2", "p1", 1, 1.0, 0.0, 1.0, True)),
        "web_events": rows(
            "event_id string, customer_id string, session_id string, event_type string, "
            "page string, device string, event_timestamp timestamp, campaign_id string",
            ("e1", "c1", "s", "view", "/", "m", dt.datetime(2024, 1, 5, 23), "not-a-campaign"),
            ("e2", None, "s", "view", "/", "m", dt.datetime(2024, 1, 5, 23), None)),
    }
    customers, products = rows("customer_id string", ("c1",)), rows("product_id string", ("p1",))
    campaigns = rows("campaign_id string", ("CAMP-1",))
    fact = gold.fct_sales(silver, customers, products, campaigns).collect()
    # A repeated order repeats its items; the last touch has no dimension row, so no campaign.
    assert [(r.order_item_id, r.campaign_key) for r in fact] == [("i1", None)] * 2
    events = gold.fct_web_events(silver, customers, campaigns).collect()
    assert [(r.session_id, r.campaign_key, r.date_key) for r in events] == [("s", None, 20240105)]
    empty = rows("full_date date", (dt.date(2024, 1, 6),))
    assert gold.fct_sales(silver, customers, products, campaigns, empty).count() == 0
    assert gold.fct_web_events(silver, customers, campaigns, empty).count() == 0


def test_broadcast_only_when_measured_small(spark, tmp_path):
    spark.range(1000).select("id", F.lit("x").alias("name")).write.parquet(str(tmp_path / "d"))
    dim = spark.read.parquet(str(tmp_path / "d"))
    assert measured_bytes(dim) == 1000 * (32 + 16 + 1 + 16)
    assert looks_small(dim)
    fact = spark.range(10)
    assert "BroadcastHashJoin" in planned(fact.join(broadcast_if_bounded(dim), "id"))
    # Small on disk but too wide in memory: no hint.
    unhinted = broadcast_if_bounded(dim, limit=20_000)
    assert unhinted._jdf.queryExecution().analyzed().toString().count("ResolvedHint") == 0


def test_auto_limit_follows_the_session(spark, conf):
    for text, size in (("-1", -1), ("10485760b", 10 * 2**20), ("50MB", 50 * 2**20), ("4096", 4096)):
        conf(autoBroadcastJoinThreshold=text)
        assert auto_limit(spark) == size


def test_small_lookup_is_splittable_without_broadcasts(spark, conf):
    small_splits(conf)
    members = spark.range(0, 500).select(F.concat(F.lit("k"), "id").alias("k")).union(
        spark.createDataFrame([("hot",)], "k string"))
    assert "SortMergeJoin(skew=true)" in final_plan(joins.keep_known(hot_fact(spark), members, "k"))


def star_of(spark, sales=3000):
    fct = spark.range(sales).select(
        F.col("id").alias("sales_key"), (F.col("id") % 700).cast("string").alias("order_id"),
        F.col("id").cast("string").alias("order_item_id"),
        (F.col("id") % 50).alias("customer_key"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("bigint").alias(
            "product_key"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 5).alias("campaign_key"),
        (F.lit(20240101) + F.col("id") % 28).cast("int").alias("date_key"),
        F.lit(2).alias("quantity"),
        *[(F.col("id") / 100).cast("decimal(18,2)").alias(n)
          for n in ("gross_amount", "discount_amount", "net_amount")],
    )
    ids = {"customer": 50, "product": 40, "campaign": 4}
    dims = {
        f"dim_{n}": spark.range(count).select(
            F.col("id").alias(f"{n}_key"), F.concat(F.lit(n), "id").alias(f"{n}_id"),
            F.concat(F.lit("name"), F.col("id") % 7).alias(f"{n}_name"),
            *[(F.col("id") % 3).cast("string").alias(x)
              for x in ("city", "state", "country", "category", "channel")])
        for n, count in ids.items()
    }
    days = spark.range(28).select(
        (F.lit(20240101) + F.col("id")).cast("int").alias("date_key"),
        F.lit(2024).alias("year"), F.lit(1).alias("month"), F.lit("January").alias("month_name"))
    return Star({**dims, "dim_date": days, "fct_sales": fct})


def test_rollup_agrees_with_a_plain_join(spark):
    from stratalake.operators.rollup import sums_by_attribute

    star = star_of(spark)
    for dim, key, attribute, how in (("dim_product", "product_key", "category", "inner"),
                                     ("dim_campaign", "campaign_key", "channel", "left")):
        got = sums_by_attribute(star.fct_sales, star.tables[dim], key, [attribute],
                                {"net": "net_amount", "units": "quantity"}, how)
        want = star.fct_sales.join(star.tables[dim], key, how).groupBy(attribute).agg(
            F.sum("net_amount").alias("net"), F.sum("quantity").alias("units"))
        assert got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect()), key=str) == sorted(
            map(tuple, want.collect()), key=str)


def test_naive_and_tuned_agree(spark):
    star = star_of(spark)
    naive, tuned = marts.naive_queries(star), marts.tuned_queries(star)
    assert list(naive) == list(tuned)
    for name in naive:
        assert naive[name].columns == tuned[name].columns
        assert naive[name].collect() == tuned[name].collect(), name
    with profile(spark, "naive"):
        assert "SortMergeJoin" in planned(marts.naive_queries(star)["revenue_by_category"])


def test_top_k_plan_and_order(spark):
    star = star_of(spark)
    top = marts.top_customers(star, 5)
    assert "TakeOrderedAndProject" in planned(top)
    found = [(r.revenue_net, r.total_orders, r.customer_id) for r in top.collect()]
    assert len(found) == 5
    assert found == sorted(found, key=lambda r: (-r[0], -r[1], r[2]))


def test_scaled_multiplies_sums_not_distincts(spark):
    star = star_of(spark)
    once, thrice = (marts.revenue_by_month(s).first() for s in (star, marts.scaled(star, 3)))
    assert thrice.revenue_net == once.revenue_net * 3
    assert thrice.total_orders == once.total_orders


def test_date_range_prunes_partitions(spark, tmp_path):
    star = star_of(spark)
    star.fct_sales.write.partitionBy("date_key").parquet(str(tmp_path / "f"))
    stored = star.changed(fct_sales=lambda _: spark.read.parquet(str(tmp_path / "f")))
    ranged = marts.between(
        Star(Frames({n: (lambda n=n: stored.tables[n]) for n in stored.tables})),
        "2024-01-03", "2024-01-04")
    plan = planned(ranged.fct_sales)
    assert "PartitionFilters: [isnotnull(date_key" in plan
    assert ranged.fct_sales.select("date_key").distinct().count() == 2


def test_rebalanced_write_splits_a_hot_partition(spark, conf, tmp_path):
    conf(adaptive__advisoryPartitionSizeInBytes="64KB", shuffle__partitions="4")
    df = hot_fact(spark).withColumn("day", F.when(F.col("k") == "hot", 1).otherwise(
        F.col("row") % 3 + 2))
    layout.write_entity(layout.cluster_for_write(df, ["day"]), str(tmp_path / "t"), ["day"])
    files = [p for p in (tmp_path / "t" / "day=1").iterdir() if p.suffix == ".parquet"]
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40_000


def test_cached_releases(spark):
    df = spark.range(10)
    with layout.cached(df) as held:
        assert held.count() == 10 and held.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_profile_restores_settings(spark):
    before = {key: spark.conf.get(key, None) for key in NAIVE}
    with profile(spark, "naive"):
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    assert {key: spark.conf.get(key, None) for key in NAIVE} == before
    with profile(spark, "tuned", 2):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
        assert spark.conf.get("spark.sql.adaptive.enabled") == TUNED["spark.sql.adaptive.enabled"]
    assert shuffle_partitions(0) == 4
    assert shuffle_partitions(2**40) == 4096
    assert shuffle_partitions(100 * 2**40) == 409_600
    assert shuffle_partitions(100 * 2**40, 4 * 2**30) == 25_600


def test_sized_widens_and_restores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized(spark, 2**40):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4096"
    with sized(spark, 2**40, 2**30):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1024"
    with sized(spark, 10):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert total_bytes([spark.range(10)]) == 80


def test_object_store_conf():
    conf = object_store_conf("http://store:9000", "id", "secret")
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert object_store_conf("https://store", "id", "secret")[
        "spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


def test_defects_hit_at_least_one_row(rows):
    df = rows("id int, email string", (5, "a@b.co"), (66, "c@d.co"), (7, "e@f.co"))
    found = {r.id: r.email for r in defects.null_email(df, "id").collect()}
    assert found == {5: None, 66: None, 7: "e@f.co"}
    items = rows("id int, quantity int", (1, 3), (2, 4))
    assert {r.id: r.quantity for r in defects.negative_quantity(items, "id").collect()} == {
        1: -3, 2: 4}


def test_lanes_and_dates_are_not_copied_into_filters(spark):
    """Filters below a join would repeat a nested expression once for each time it is written."""
    text = spark.range(8).select(F.concat(F.lit("2024-01-0"), F.col("id") + 1).alias("day"), "id")
    left = text.select("id", c.date(c.timestamp("day")).alias("day"))
    weeks = F.date_add(F.lit("2024-01-02").cast("date"), F.col("id").cast("int") * 7)
    right = spark.range(4).select(weeks.alias("day")).distinct()
    joined = joins.splittable_join(left, right, ["day"], "left_semi")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and all("xxhash64" not in line for line in filters)
    assert max(line.count("concat(") for line in filters) <= 1
    assert [row["id"] for row in joined.collect()] == [1]


def test_naive_campaigns_spread_sales_without_one(spark):
    """Sales without a campaign go to all reducers, and the join stays a sort-merge join."""
    sales = spark.range(400).select(
        F.when(F.col("id") < 0, F.col("id")).alias("campaign_key"), F.lit(1).alias("net_amount"))
    campaigns = spark.range(3).select(
        F.col("id").alias("campaign_key"), F.lit("c").alias("campaign_name"))
    star = Star({"fct_sales": sales, "dim_campaign": campaigns})
    found = marts.BENCHMARKS["revenue_by_campaign"].build(star, tuned=False)
    assert [tuple(row) for row in found.collect()] == [("unattributed", 400)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "__lane" in plan
