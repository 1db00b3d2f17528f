"""Refreshes, dense keys, bitmaps, exact shares, clustered files and folded histories."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks.lake import Lake
from checks.upkeep import SECOND, refreshed, text_files
from stratalake.operators import bitmaps, defects, dense_keys, layout
from stratalake.plans import refresh, runlog, runner
from stratalake.plans.runlog import Run
from stratalake.session import settings
from stratalake.sources.layers import read_gold

SF_DIR = "/root/testdata/sf0.001"


# --- refresh ----------------------------------------------------------------------------------


def files_by_day(root: str) -> dict[str, set[str]]:
    return {folder.name.partition("=")[2]: {f.name for f in folder.glob("*.parquet")}
            for folder in Path(root).glob("date_key=*")}


def plain(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_a_refresh_equals_a_rebuild_and_leaves_other_days_alone(spark, tmp_path, monkeypatch):
    before = {}

    def looked_at(spark, silver_root, gold_root, dates, history=None):
        before.update({t: files_by_day(f"{gold_root}/{t}") for t in ("fct_sales", "fct_web_events")})
        return kept(spark, silver_root, gold_root, dates, history)

    kept = runner.refresh_gold
    monkeypatch.setattr(runner, "refresh_gold", looked_at)
    silver_root, gold_root = refreshed(Lake(spark, SF_DIR))
    rebuilt = str(tmp_path / "gold")
    runner.silver_to_gold(spark, silver_root, rebuilt)
    ours, theirs = read_gold(spark, gold_root), read_gold(spark, rebuilt)
    for table in ours:
        assert plain(ours[table]) == plain(theirs[table]), table
    for table in before:
        after = files_by_day(f"{gold_root}/{table}")
        same = {day for day, files in before[table].items() if after[day] == files}
        changed = set(after) - same
        assert same and changed, table
        if table == "fct_sales":
            assert {"20240103", "20240107"} <= changed
    written = files_by_day(f"{gold_root}/fct_sales")
    kept(spark, silver_root, gold_root, ["1999-01-01"])  # nothing new: no change
    assert files_by_day(f"{gold_root}/fct_sales") == written
    kept(spark, silver_root, gold_root, [SECOND])  # repeated
    assert plain(read_gold(spark, gold_root)["fct_sales"]) == plain(theirs["fct_sales"])


def test_days_reached_from_each_entity(rows):
    orders = rows("order_id string, customer_id string, d int, is_valid_status boolean",
                  *[(f"o{k}", f"c{k % 3}", k, k != 5) for k in range(1, 7)]).selectExpr(
        "order_id", "customer_id", "is_valid_status", "'card' as payment_method",
        "'paid' as order_status",
        "to_timestamp(concat('2024-01-0', d, ' 09:00:00')) as order_date")
    items = rows("order_item_id string, order_id string, product_id string",
                 *[(f"i{k}", f"o{k}", f"p{k % 2}") for k in range(1, 7)])
    events = rows("event_id string, customer_id string, event_type string, campaign_id string, d int",
                  ("e1", "c1", "view", "g1", 1), ("e2", "c1", "view", None, 4),
                  ("e3", "c2", "view", "g2", 2), ("e4", "c0", "view", "g1", 4)).selectExpr(
        "*", "to_timestamp(concat('2024-01-0', d, ' 23:00:00')) as event_timestamp")
    silver = {"orders": orders, "order_items": items, "web_events": events}

    def days(found):
        return sorted(r.full_date.day for r in found.collect())

    def sales(**added):
        return days(refresh.touched_sales_days(silver, added))

    assert sales(orders=orders.where("order_id in ('o2', 'o5')")) == [2]  # o5 has no valid status
    assert sales(order_items=items.where("order_id in ('o3', 'o6')")) == [3, 6]
    assert sales(web_events=events.where("event_id = 'e1'")) == [1]
    assert sales(web_events=events.where("event_id in ('e2', 'e4')")) == []  # none that day
    assert sales(customers=rows("customer_id string", ("c0",))) == [3, 6]
    assert sales(products=rows("product_id string", ("p0",))) == [2, 4, 6]
    assert sales(campaigns=rows("campaign_id string", ("g2",))) == [2]
    assert days(refresh.touched_event_days(
        silver, {"customers": rows("customer_id string", ("c1",))})) == [1, 4]
    assert days(refresh.touched_event_days(
        silver, {"campaigns": rows("campaign_id string", ("g1",))})) == [1, 4]
    with pytest.raises(ValueError):
        refresh.touched_event_days(silver, {})


# --- dense keys and bitmaps -------------------------------------------------------------------


def test_dense_keys_over_loads(spark, tmp_path):
    path, ids = str(tmp_path / "keys"), [f"id{k % 700}" for k in range(2000)]
    frame = spark.createDataFrame([(i,) for i in [*ids, None]], "id string")
    first = {r.id: r.dense_key for r in dense_keys.extended_map(frame, "id", path).collect()}
    assert sorted(first.values()) == list(range(1, 701))
    assert sorted(first, key=first.get) == sorted(first)  # in the order of the ids
    assert dense_keys.extended_map(frame, "id", path).count() == 700  # repeated: nothing new
    more = frame.unionByName(spark.createDataFrame([(f"a{k}",) for k in range(50)], "id string"))
    second = {r.id: r.dense_key for r in dense_keys.extended_map(more, "id", path).collect()}
    assert second | first == second and sorted(second.values()) == list(range(1, 751))
    assert dense_keys.new_keys(frame.limit(0), "id").count() == 0


def test_bitmaps_merge_without_expanding(spark):
    random.seed(4)
    data = [(d, random.randrange(1, 100_000), random.randrange(1, 40)) for d in range(20)
            for _ in range(300)]
    frame = spark.createDataFrame([*data, (3, None, None)], "day int, big long, small long")
    found = bitmaps.distinct_bitmaps(frame, ["day"], "big")
    months = found.withColumn("month", F.col("day") % 3)
    parts = months.where("day < 7").unionByName(months.where("day >= 7"))
    counts = bitmaps.distinct_counts(bitmaps.merged(parts, ["month"]), ["month"], "n")
    want = frame.groupBy((F.col("day") % 3).alias("month")).agg(F.count_distinct("big").alias("n"))
    assert plain(counts) == plain(want)
    assert "Expand" not in counts._jdf.queryExecution().toString()


# --- exact shares -----------------------------------------------------------------------------


@pytest.mark.parametrize("rows,share", [(1, 0.03), (50, 0.03), (1000, 0.03), (999, 0.5), (10, 1.0)])
def test_exact_share(spark, rows, share):
    frame = spark.range(rows)
    found = defects.exact_share(frame, ["id"], share)
    chosen = {r.id for r in found.where("is_chosen").collect()}
    assert found.count() == rows and len(chosen) == max(1, round(share * rows))
    again = defects.exact_share(frame.repartition(5).orderBy(F.desc("id")), ["id"], share)
    assert {r.id for r in again.where("is_chosen").collect()} == chosen


def test_shares_with_repeated_keys_and_none(spark):
    same = spark.range(100).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    assert defects.exact_share(same, ["k"], 0.25).where("is_chosen").count() == 25
    equal = spark.range(100).select(F.lit(7).alias("k"))
    assert defects.exact_share(equal, ["k"], 0.25).where("is_chosen").count() == 25
    assert defects.exact_share(same.limit(0), ["k"]).count() == 0
    injected = defects.inject_share(same, "v", F.lit(-1), ["v"], 0.1)
    assert injected.where("v = -1").count() == 10 and injected.columns == ["k", "v"]


# --- layout -----------------------------------------------------------------------------------


def test_a_filter_on_one_column_reads_few_files(spark, tmp_path):
    frame = spark.range(60_000).select(
        F.expr("date_add(date'2024-01-01', cast(id * 7919 % 360 as int))").alias("day"),
        (F.col("id") * 104_729 % 5_003).alias("customer"),
        F.when(F.col("id") % 50 > 0, F.col("id") * 15_485_863 % 997).alias("product"))
    path = tmp_path / "clustered"
    columns = ["day", "customer", "product"]
    layout.cluster_by_ranges(frame, columns, 128).write.option("maxRecordsPerFile", 150).parquet(
        str(path))
    assert plain(spark.read.parquet(str(path))) == plain(frame)
    stats = []
    for file in path.glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for group in range(meta.num_row_groups):
            stats.append([meta.row_group(group).column(k).statistics for k in range(3)])
    for column, value in enumerate((date(2024, 5, 5), 2_500, 500)):
        met = sum(s[column].min <= value <= s[column].max for s in stats if s[column].has_min_max)
        assert 0 < met <= len(stats) / 3, columns[column]
    met = sum(s[1].min <= 2_500 <= s[1].max for s in stats)
    assert met < len(stats) / 4


def test_a_selective_dimension_sends_a_bloom_filter(spark, tmp_path):
    fact, members = str(tmp_path / "fact"), str(tmp_path / "members")
    spark.range(200_000).select((F.col("id") % 10_000).alias("k"), "id").write.parquet(fact)
    spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") % 100).alias("part")).write.parquet(
        members)
    with settings(spark, {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}):
        met = spark.read.parquet(fact).join(spark.read.parquet(members).where("part = 3"), "k")
        assert "might_contain" in met._jdf.queryExecution().optimizedPlan().toString()
        assert met.count() == 2_000


# --- history ----------------------------------------------------------------------------------


def test_folds_lose_and_repeat_nothing(spark, tmp_path):
    path, begin = str(tmp_path / "history"), datetime(2024, 1, 1)
    assert runlog.read_history(spark, path).count() == 0

    def add_many(numbers) -> None:
        for number in numbers:
            at = begin + timedelta(minutes=number)
            runlog.append_run(spark, path, Run(f"job{number}", "raw", "bronze", at, at))

    with ThreadPoolExecutor(3) as pool:  # two writers and someone who folds
        running = [pool.submit(add_many, range(0, 24, 2)), pool.submit(add_many, range(1, 24, 2))]
        for _ in range(2):
            runlog.fold_history(spark, path)
        for one in running:
            one.result()
    names = [r.job_name for r in runlog.read_history(spark, path).collect()]
    assert names == [f"job{k}" for k in range(23, -1, -1)]
    runlog.fold_history(spark, path)
    fold = runlog._latest_fold(spark, path)
    assert len(fold.inputFiles()) == 1 and fold.count() == 24
    assert runlog._open_runs(spark, path, fold) is None  # no file of a single run is opened
    run = Run("late", "raw", "bronze", begin, begin)
    runlog.append_run(spark, path, run)
    found = runlog.read_history(spark, path)
    assert found.count() == 25 and len(found.inputFiles()) == 2
    assert found.schema == spark.createDataFrame([], runlog.RUN_SCHEMA).schema


# --- split sources ----------------------------------------------------------------------------


def test_split_sources_are_written_by_tasks(spark):
    """No row holds a file, and every task writes a whole one, empty or not."""
    lake, lines = Lake(spark, SF_DIR), spark.range(0, 20, 1, 4).where("id < 10 or id > 16")
    for comma, end in ((",", "]"), ("", "")):
        path = text_files(lines.select(F.concat(F.lit("a\n"), "id")), "lines", lake, "[", comma, end)
        found = sorted(file.read_text() for file in Path(path).glob("part-*"))
        last = f"{end}\n" if end else ""
        wanted = [range(5), range(5, 10), [], range(17, 20)]
        assert found == sorted(
            "[\n" + f"{comma}\n".join(f"a\n{i}" for i in ids) + ("\n" if ids else "") + last
            for ids in wanted)
