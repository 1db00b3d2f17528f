"""Raw to gold on hand-made files, and the run log around it."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake.functions import columns as c
from stratalake.plans import runlog, runner
from stratalake.schemas import GOLD_TABLES, LINEAGE_COLUMNS, RAW_ENTITIES
from stratalake.sources import catalog
from stratalake.sources.raw import missing_columns, read_entity
from tests.cases import write_raw


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    write_raw(root / "raw")
    paths = {name: str(root / name) for name in ("raw", "bronze", "silver", "gold", "history")}
    history = paths["history"]
    paths["bronze_run"] = runner.raw_to_bronze(
        spark, paths["raw"], paths["bronze"], history, multi_line=True)
    paths["silver_run"] = runner.bronze_to_silver(spark, paths["bronze"], paths["silver"], history)
    paths["gold_run"] = runner.silver_to_gold(spark, paths["silver"], paths["gold"], history)
    return paths


def table(spark, lake, layer, name):
    return spark.read.parquet(f"{lake[layer]}/{name}")


def by_key(spark, lake, layer, name, key):
    return {row[key]: row for row in table(spark, lake, layer, name).collect()}


def test_bronze_keeps_rows_and_adds_lineage(spark, lake):
    assert [(m.entity, m.records_in, m.records_out) for m in lake["bronze_run"]] == [
        ("customers", 4, 4), ("products", 4, 4), ("campaigns", 3, 3),
        ("orders", 3, 3), ("order_items", 4, 4), ("web_events", 3, 3),
    ]
    for name, entity in RAW_ENTITIES.items():
        df = table(spark, lake, "bronze", name)
        assert set(LINEAGE_COLUMNS) < set(df.columns)
        assert df.select("source_file").distinct().collect()[0][0] == entity.file_name
        kinds = dict(df.dtypes)
        assert all(kinds[column] == kind for column, kind in entity.columns.items())
    orders = by_key(spark, lake, "bronze", "orders", "order_id")
    assert orders["O-51"].customer_id == "K7" and orders["O-51"].order_status == " Shipped"


def test_silver_customers(spark, lake):
    found = by_key(spark, lake, "silver", "customers", "customer_id")
    assert {key: (row.email, row.is_email_valid) for key, row in found.items()} == {
        "K7": ("ines.okafor@mail.test", True), "K8": (None, False), "K9": ("pia-at-mail", False)}


def test_silver_products(spark, lake):
    found = by_key(spark, lake, "silver", "products", "product_id")
    assert {key: (row.category, row.unit_price) for key, row in found.items()} == {
        "rake-4": ("hand_tools", 12.5), "bulb-9": ("seeds_bulbs", 0.0), "pot-2": ("unknown", 7.75)}


def test_silver_campaigns(spark, lake):
    found = by_key(spark, lake, "silver", "campaigns", "campaign_id")
    assert {key: (row.budget, row.end_date) for key, row in found.items()} == {
        "W1": (240.5, dt.date(2023, 9, 30)), "W2": (80.0, None), "W3": (0.0, dt.date(2023, 9, 12))}


def test_silver_orders_items_events(spark, lake):
    orders = by_key(spark, lake, "silver", "orders", "order_id")
    assert {key: (row.order_status, row.is_valid_status) for key, row in orders.items()} == {
        "O-51": ("shipped", True), "O-52": ("paid", True), "O-53": (None, False)}
    items = by_key(spark, lake, "silver", "order_items", "order_item_id")
    assert {key: (row.gross_amount, row.net_amount, row.is_quantity_valid)
            for key, row in items.items()} == {
        "O-51/a": (Decimal("37.50"), Decimal("36.25"), True),
        "O-51/b": (Decimal("0.00"), Decimal("0.00"), False),
        "O-52/a": (Decimal("15.50"), Decimal("15.00"), True),
        "O-53/a": (Decimal("7.75"), Decimal("7.75"), True)}
    events = by_key(spark, lake, "silver", "web_events", "event_id")
    assert {key: (row.event_type, row.campaign_id) for key, row in events.items()} == {
        "v1": ("view_item", "W1"), "v2": ("check_out", None), "v3": ("view_item", "W2")}


def test_silver_counts_raw_price_and_budget_defects(lake):
    counts = {m.entity: (m.records_in, m.records_out, m.invalid_records, m.quality_percentage)
              for m in lake["silver_run"]}
    assert counts == {
        "customers": (4, 3, 3, 25.0),  # two bad addresses and a missing id
        "products": (4, 3, 2, 50.0),  # a negative price and a blank id
        "campaigns": (3, 3, 2, 33.33),  # an unreadable date and a negative budget
        "orders": (3, 3, 1, 66.67),
        "order_items": (4, 4, 1, 75.0),
        "web_events": (3, 3, 0, 100.0),  # a missing customer counts in gold only
    }


def test_gold_star(spark, lake):
    sizes = {name: table(spark, lake, "gold", name).count() for name in GOLD_TABLES}
    assert sizes == {"dim_customer": 3, "dim_product": 3, "dim_campaign": 3, "dim_date": 3,
                     "fct_sales": 2, "fct_web_events": 2}
    sales = by_key(spark, lake, "gold", "fct_sales", "order_item_id")
    sale = sales["O-51/a"]
    assert (sale.net_amount, sale.order_status, sale.date_key) == (
        Decimal("36.25"), "shipped", 20230904)
    for name, member in (("customer", "K7"), ("product", "rake-4"), ("campaign", "W1")):
        members = by_key(spark, lake, "gold", f"dim_{name}", f"{name}_id")
        assert sale[f"{name}_key"] == members[member][f"{name}_key"]
    assert sales["O-52/a"].campaign_key is None  # the touch came a day later
    events = by_key(spark, lake, "gold", "fct_web_events", "session_id")
    assert events["s-k7"].campaign_key == sale.campaign_key
    assert events["s-k8"].campaign_key is None
    for name, spec in GOLD_TABLES.items():
        assert dict(table(spark, lake, "gold", name).dtypes) == spec.columns
    inputs = {m.entity: m.records_in for m in lake["gold_run"]}
    assert inputs["dim_date"] == 6 and inputs["fct_sales"] == 4


def test_run_history(spark, lake):
    runs = runlog.read_history(spark, lake["history"])
    found = {r.job_name: r for r in runs.collect()}
    assert {n: r.status for n, r in found.items()} == {
        "raw_to_bronze": "success", "bronze_to_silver": "warning", "silver_to_gold": "warning"}
    bronze = found["raw_to_bronze"]
    assert bronze.valid_data_percentage == 100.0 and bronze.records_in == 21
    assert len(bronze.generated_files) == 6 and bronze.approx_file_size_bytes > 0
    assert [m.entity for m in bronze.entity_metrics] == list(RAW_ENTITIES)
    assert runs.first().job_name == "silver_to_gold"
    summary = runlog.history_summary(runs).first()
    assert summary.asDict() == {
        "total_executions": 3, "success_executions": 1, "warning_executions": 2,
        "failed_executions": 0, "last_job_name": "silver_to_gold"}


def test_a_second_date_does_not_count_the_first(spark, lake, tmp_path):
    silver = str(tmp_path / "silver")
    for day in (1, 2):
        bronze = str(tmp_path / f"bronze{day}")
        runner.raw_to_bronze(spark, lake["raw"], bronze, multi_line=True,
                             started_at=dt.datetime(2023, 10, day))
        counts = runner.bronze_to_silver(spark, bronze, silver, keep_other_dates=True)
        assert {m.entity: m.records_out for m in counts} == {
            m.entity: m.records_out for m in lake["silver_run"]}
    assert spark.read.parquet(f"{silver}/orders").count() == 6


def test_failed_run_is_recorded(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="customers.*web_events"):
        runner.raw_to_bronze(spark, str(tmp_path / "none"), str(tmp_path / "out"),
                             str(tmp_path / "history"))
    run = runlog.read_history(spark, str(tmp_path / "history")).first()
    assert run.status == "failed" and "missing input datasets" in run.error_message


def test_a_failing_entity_keeps_the_others(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    (raw / "orders.csv").write_text("order_id,order_date\n1,2024-01-01\n")
    with pytest.raises(ValueError, match="orders: required columns missing: customer_id"):
        runner.raw_to_bronze(spark, str(raw), str(tmp_path / "out"), str(tmp_path / "history"),
                             multi_line=True)
    run = runlog.read_history(spark, str(tmp_path / "history")).first()
    assert run.status == "failed"
    others = [n for n in RAW_ENTITIES if n != "orders"]
    assert [m.entity for m in run.entity_metrics] == others
    assert {item.path.rsplit("/", 1)[1] for item in run.generated_files} == set(others)


def test_quality_results_are_stored(spark, lake, tmp_path):
    results = runner.quality_checks(
        spark, lake["silver"], lake["gold"], str(tmp_path / "dq"), lake["raw"], lake["bronze"])
    rows = results.collect()
    # 15 base rules, 6 on repeated keys, 7 references, 6 raw files, 6 bronze schemas.
    assert len(rows) == 40 and all(row.passed for row in rows)
    assert {row.severity for row in rows if row.rule_name == "gold_fact_dimension_integrity"} == {
        "critical"}
    assert {row.layer for row in rows} == {"raw", "bronze", "silver", "gold"}
    summary = spark.read.json(str(tmp_path / "dq" / "summary")).first()
    assert (summary.total_checks, summary.failed_checks) == (40, 0)
    assert summary.duration_seconds >= 0
    assert runner.quality_checks(spark, lake["silver"], lake["gold"]).count() == 28


def test_publish(spark, lake, tmp_path):
    listing = catalog.publish(spark, lake["gold"], str(tmp_path / "serving"))
    counts = {f"{r.schema_name}.{r.table_name}": r.row_count for r in listing.collect()}
    assert len(counts) == 11
    assert counts["gold.fct_sales"] == 2 and counts["analytics.campaign_performance"] == 3
    mart = spark.table("gold.dm_sales_overview").collect()
    assert {(r.channel, r.category, r.total_orders) for r in mart} == {
        ("newsletter", "hand_tools", 1), ("organic_or_unknown", "unknown", 1)}
    # A second run replaces everything.
    again = catalog.publish(spark, lake["gold"], str(tmp_path / "serving"))
    assert {f"{r.schema_name}.{r.table_name}": r.row_count for r in again.collect()} == counts


def test_a_failing_query_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "serving")
    catalog.materialise(spark, {"kept": "select 5 as n"}, root, "switching")
    with pytest.raises(Exception, match="broken"):
        catalog.materialise(
            spark, {"kept": "select cast(raise_error('broken') as int) as n"}, root, "switching")
    assert spark.table("switching.kept").first().n == 5
    catalog.materialise(spark, {"kept": "select 6 as n"}, root, "switching")
    assert spark.table("switching.kept").first().n == 6


def test_sql_files_become_tables(spark, lake, tmp_path):
    catalog.publish_gold(spark, lake["gold"])
    folder = tmp_path / "sql"
    folder.mkdir()
    (folder / "net_by_status.sql").write_text(
        "SELECT order_status, SUM(net_amount) AS net FROM gold.fct_sales GROUP BY order_status;\n")
    (folder / "notes.txt").write_text("ignored")
    queries = catalog.sql_files(spark, str(folder))
    assert list(queries) == ["net_by_status"]
    catalog.materialise(spark, queries, str(tmp_path / "out"))
    found = {row.order_status: row.net for row in spark.table("analytics.net_by_status").collect()}
    assert found == {"shipped": Decimal("36.25"), "paid": Decimal("15.00")}


def test_partition_overwrite_modes(spark, lake, tmp_path):
    from stratalake.operators.layout import write_entity

    def day(text, n):
        return spark.range(n).select("id", F.lit(text).cast("date").alias("processing_date"))

    target = str(tmp_path / "t")
    write_entity(day("2024-01-01", 3), target, ["processing_date"])
    write_entity(day("2024-01-02", 2), target, ["processing_date"], keep_other_partitions=True)
    assert spark.read.parquet(target).count() == 5
    write_entity(day("2024-01-02", 1), target, ["processing_date"], keep_other_partitions=True)
    assert spark.read.parquet(target).count() == 4
    write_entity(day("2024-01-03", 1), target, ["processing_date"])
    assert spark.read.parquet(target).count() == 1


def test_csv_columns_by_name_and_type(spark, tmp_path):
    (tmp_path / "i.csv").write_text(
        "quantity,order_item_id,unit_price,extra\n2.5,A,abc,x\n,B,,\n")
    df = read_entity(spark, str(tmp_path / "i.csv"), "order_items", "csv")
    assert dict(df.dtypes) == {"quantity": "int", "order_item_id": "string",
                               "unit_price": "double", "extra": "string"}
    assert [tuple(r) for r in df.orderBy("order_item_id").collect()] == [
        (2, "A", None, "x"), (None, "B", None, None)]
    assert missing_columns(df, "order_items") == ["order_id", "product_id", "discount_amount"]


def test_csv_files_with_other_headers_fail(spark, tmp_path):
    folder = tmp_path / "orders.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("order_id,order_date\nO-1,2023-09-04\n")
    (folder / "b.csv").write_text("order_date,order_id\n2023-09-05,O-2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_entity(spark, str(folder), "orders", "csv").collect()


def test_json_columns_are_those_of_the_data(spark, tmp_path):
    (tmp_path / "e.json").write_text(
        '{"event_id": "1", "page": "/", "score": 2.5}\n{"event_id": "2"}\n')
    df = read_entity(spark, str(tmp_path / "e.json"), "web_events")
    assert dict(df.dtypes) == {"event_id": "string", "page": "string", "score": "string"}
    assert df.count() == 2 and df.filter("page is null").count() == 1
    assert "campaign_id" in missing_columns(df, "web_events")


@pytest.mark.parametrize("text, key", [
    ("9999-12-31", 99991231), ("0001-01-01", 10101), ("0000-06-01", None), ("10000-01-01", None),
    ("12345-01-01", None), ("300000-01-01", None), ("soon", None)])
def test_dates_outside_the_calendar_are_null(rows, text, key):
    found = rows("d string", (text,)).select(
        c.date("d").alias("day"), c.timestamp("d").alias("moment"))
    day, moment = found.select(c.date_key(F.col("day")), F.col("moment").isNotNull()).first()
    assert day == key and moment == (key is not None)


def test_source_file_from_metadata(spark, tmp_path):
    from stratalake.plans.bronze import add_lineage

    (tmp_path / "c").mkdir()
    for part in ("a.csv", "b.csv"):
        (tmp_path / "c" / part).write_text("customer_id\nX\n")
    df = spark.read.option("header", True).csv(str(tmp_path / "c"))
    found = add_lineage(df, None, dt.datetime(2024, 1, 1)).select("source_file").collect()
    assert sorted(r[0] for r in found) == ["a.csv", "b.csv"]


def test_surrogate_key_is_stable_and_null_safe(spark, rows):
    df = rows("a string, b string", ("x", None), ("x", "__null__"), (None, None))
    keys = [r[0] for r in df.select(c.surrogate_key("a", "b")).collect()]
    assert keys[0] == keys[1] != keys[2] and all(0 <= key < 2**63 - 1 for key in keys)
