"""Every checkable operator as a query over the test tables, with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.duck import EMAIL, STATUSES, token, with_ctes
from checks.lake import RUN_AT, Lake
from checks.raw_entities import RAW_SQL
from stratalake.functions import columns as c
from stratalake.operators import attribution, dedup, defects, joins, layout, quality
from stratalake.operators.sizes import broadcast_if_bounded
from stratalake.plans import gold, marts, runlog, runner, silver, storage_profile
from stratalake.plans.frames import Star
from stratalake.schemas import GOLD_TABLES, RAW_ENTITIES
from stratalake.sources import catalog
from stratalake.sources.files import artifact_sizes, list_files, list_layers
from stratalake.sources.raw import read_entity

QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, build: Callable[[Lake], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = build
    if sql is not None:
        ORACLES[name] = with_ctes(sql)


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        register(name, build, sql)
        return build

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and timestamps as text: the same in any engine's client."""

    def plain(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])


# --- A: sources and sinks ---------------------------------------------------------------------

register(
    "a3_parquet_scan",
    lambda lake: lake.table("orders"),
    "select * replace (cast(o_orderdate as string) as o_orderdate) from orders",
)


def csv_copy(lake: Lake, entity: str) -> str:
    """The raw entity written as header CSV, several files, whitespace kept."""
    path = lake.scratch(f"{entity}.csv")
    writer = lake.raw(entity).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(
        path)
    return path


register(
    "a1_csv_scan_items",
    lambda lake: read_entity(lake.spark, csv_copy(lake, "order_items"), "order_items"),
    "select * from raw_order_items",
)
register(
    "a1_csv_scan_customers",
    lambda lake: read_entity(lake.spark, csv_copy(lake, "customers"), "customers"),
    "select * from raw_customers",
)


@query(
    "a2_json_scan",
    """select event_id, customer_id, session_id, event_type, page, device, campaign_id,
              cast(cast(event_timestamp as timestamp) as string) as event_timestamp
       from raw_web_events""",
)
def json_scan(lake: Lake) -> DataFrame:
    path = lake.scratch("web_events.json")
    text = F.col("event_timestamp").cast("string")  # as text, with all its digits
    lake.raw("web_events").withColumn("event_timestamp", text).write.json(path)
    events = read_entity(lake.spark, path, "web_events", multi_line=False)
    return events.withColumn("event_timestamp", c.timestamp("event_timestamp"))


@query(
    "a5_partitioned_write",
    """select order_id, customer_id, order_status, cast(cast(order_date as date) as string) as day
       from s_orders""",
)
def partitioned_write(lake: Lake) -> DataFrame:
    path = lake.scratch("orders")
    orders = lake.silver["orders"].select(
        "order_id", "customer_id", "order_status", c.date("order_date").alias("day"))
    for _ in range(2):  # an overwrite, not an append
        layout.write_entity(layout.cluster_for_write(orders, ["day"]), path, ["day"])
    return lake.spark.read.parquet(path)


def _bronze_entity(entity: str) -> Callable[[Lake], DataFrame]:
    def build(lake: Lake) -> DataFrame:
        target = lake.scratch("bronze")
        runner.raw_to_bronze(
            lake.spark, lake.deliver(entity), target, started_at=RUN_AT, entities=[entity])
        df = lake.spark.read.parquet(f"{target}/{entity}")
        if entity == "web_events":
            df = df.withColumn("event_timestamp", c.timestamp("event_timestamp"))
        return df

    return build


for _name, _entity in RAW_ENTITIES.items():
    _more = {"products": "*, '2023-01-01' as created_at", "web_events": "* replace (cast(cast("
             "event_timestamp as timestamp) as string) as event_timestamp)"}.get(_name, "*")
    register(
        f"j1_bronze_{_name}",
        _bronze_entity(_name),
        f"""select {_more}, '2024-04-01 06:30:15' as ingestion_timestamp,
                   '{_entity.file_name}' as source_file, '2024-04-01' as processing_date
            from raw_{_name}""",
    )


@query(
    "a6_written_counts",
    " union all ".join(
        f"select '{name}' as entity, (select count(*) from raw_{name}) as records_in, "
        f"(select count(*) from s_{name}) as records_out, "
        f"2 * (select count(*) from s_{name}) as stored_rows"
        for name in ("customers", "orders")
    ),
)
def written_counts(lake: Lake) -> DataFrame:
    """Two processing dates; the counts of the second write do not include the first."""
    target, names = lake.scratch("silver"), ["customers", "orders"]
    for day in (1, 2):
        bronze_root = lake.scratch("bronze")
        for name in names:
            runner.raw_to_bronze(
                lake.spark, lake.deliver(name), bronze_root, entities=[name],
                started_at=RUN_AT + timedelta(days=day))
        metrics = runner.bronze_to_silver(
            lake.spark, bronze_root, target, keep_other_dates=True, entities=names)
    counts = lake.spark.createDataFrame(
        [(m.entity, m.records_in, m.records_out) for m in metrics],
        "entity string, records_in bigint, records_out bigint")
    stored = [lake.spark.read.parquet(f"{target}/{name}").agg(F.count("*").alias("stored_rows"))
              .withColumn("entity", F.lit(name)) for name in names]
    return counts.join(reduce(DataFrame.unionByName, stored), "entity")


@query(
    "a9_publication_manifest",
    " union all ".join(
        f"select 'gold' as schema_name, '{name}' as table_name, count(*) as row_count, "
        f"'gold/{name}' as source from "
        + {"fct_sales": "g_sales", "fct_web_events": "g_events"}.get(name, f"g_{name}")
        for name in GOLD_TABLES
    ),
)
def manifest(lake: Lake) -> DataFrame:
    return catalog.manifest(
        {f"gold.{name}": (df, f"gold/{name}") for name, df in lake.tables.items()}
    )


MART_SQL = """
    select cast(s.full_date as string) as full_date, c.country, c.state, p.category,
           coalesce(g.channel, 'organic_or_unknown') as channel,
           cast(sum(quantity) as bigint) as total_quantity,
           cast(sum(gross_amount) as double) as total_gross_amount,
           cast(sum(discount_amount) as double) as total_discount_amount,
           cast(sum(net_amount) as double) as total_net_amount,
           count(distinct order_id) as total_orders
    from g_sales s join g_dim_customer c using (customer_id) join g_dim_product p using (product_id)
         left join g_dim_campaign g on g.campaign_id = s.campaign_id
    group by all"""


@query("a10_mart_view", MART_SQL)
def mart_view(lake: Lake) -> DataFrame:
    used = {n: df for n, df in lake.tables.items() if "{" + n + "}" in marts.SALES_OVERVIEW_SQL}
    return lake.spark.sql(marts.SALES_OVERVIEW_SQL, **used)


def order_folders(lake: Lake) -> str:
    """The orders written by status, one file for each."""
    path = lake.scratch("by_status")
    lake.table("orders").repartition("o_orderstatus").write.partitionBy("o_orderstatus").parquet(
        path)
    return path


register(
    "a13_file_listing",
    lambda lake: list_files(lake.spark, order_folders(lake)).select(
        F.regexp_extract("path", "o_orderstatus=([^/]+)/[^/]+$", 1).alias("status"),
        (F.col("length") > 0).alias("has_bytes")),
    "select o_orderstatus as status, true as has_bytes from orders group by o_orderstatus",
)


@query(
    "a8_published_tables",
    " union all ".join([
        *(f"select 'gold' as schema_name, '{name}' as table_name, count(*) as row_count from "
          + {"fct_sales": "g_sales", "fct_web_events": "g_events"}.get(name, f"g_{name}")
          for name in GOLD_TABLES),
        "select 'analytics', 'campaign_performance', count(*) from g_dim_campaign",
        """select 'analytics', 'events_by_channel', count(*) from (
             select distinct coalesce(channel, 'organic_or_unknown'), event_type
             from g_events e left join g_dim_campaign c on c.campaign_id = e.campaign_id)""",
        """select 'analytics', 'revenue_by_category', count(distinct category)
           from g_sales join g_dim_product using (product_id)""",
        """select 'analytics', 'revenue_by_month', count(*) from (
             select distinct year, month from g_sales join g_dim_date using (date_key))""",
        """select 'analytics', 'top_customers', least(20, count(distinct customer_id))
           from g_sales""",
    ]),
)
def published_tables(lake: Lake) -> DataFrame:
    """Gold stored and published, the analytics materialised, all of it read back and counted."""
    root = lake.scratch("gold")
    for name, df in lake.tables.items():
        layout.write_entity(df, f"{root}/{name}", GOLD_TABLES[name].partitioned_by)
    return catalog.publish(lake.spark, root, lake.scratch("serving")).drop("source")


# --- B: projections ---------------------------------------------------------------------------

register(
    "b1_add_lineage",
    lambda lake: lake.bronze("orders").select(
        "order_id", "ingestion_timestamp", "source_file", "processing_date"
    ),
    """select order_id, '2024-04-01 06:30:15' as ingestion_timestamp,
              'orders.src' as source_file, '2024-04-01' as processing_date from raw_orders""",
)


@query(
    "b2_standardise_lineage",
    """select event_id, cast(cast(event_timestamp as timestamp) as string) as ingestion_timestamp,
              page as source_file, cast(cast(event_timestamp as date) as string) as processing_date
       from raw_web_events""",
)
def standardise(lake: Lake) -> DataFrame:
    text = lake.raw("web_events").select(
        "event_id",
        F.col("event_timestamp").cast("string").alias("ingestion_timestamp"),
        F.col("page").alias("source_file"),
        F.col("event_timestamp").cast("date").cast("string").alias("processing_date"),
    )
    return silver.standardise_lineage(text)


register(
    "b3_normalise_token",
    lambda lake: lake.raw("products").select("product_name", c.token("category").alias("token")),
    f"select product_name, {token('category')} as token from raw_products",
)
register(
    "b4_trim_id",
    lambda lake: lake.raw("customers").select(
        "customer_name", c.trimmed("customer_id").alias("customer_id")
    ),
    "select customer_name, trim(customer_id) as customer_id from raw_customers",
)
register(
    "b5_blank_to_default",
    lambda lake: lake.raw("products").select(
        "product_name", c.blank_as("category", c.token("category"), "unknown").alias("category")
    ),
    f"""select product_name, coalesce(nullif({token('category')}, ''), 'unknown') as category
        from raw_products""",
)
register(
    "b5_blank_to_null",
    lambda lake: lake.raw("web_events").select(
        "event_id", c.blank_as("event_type", c.token("event_type")).alias("event_type")
    ),
    f"select event_id, nullif({token('event_type')}, '') as event_type from raw_web_events",
)
register(
    "b6_email_normalise",
    lambda lake: lake.raw("customers").select(
        "customer_name", c.email_address("email").alias("email")
    ),
    "select customer_name, lower(nullif(trim(email), '')) as email from raw_customers",
)
register(
    "b7_email_flag",
    lambda lake: lake.raw("customers").select(
        "customer_name", c.is_email(c.email_address("email")).alias("is_email_valid")
    ),
    f"""select customer_name, coalesce(regexp_matches(lower(trim(email)), '{EMAIL}'), false)
            as is_email_valid from raw_customers""",
)
register(
    "b8_non_negative_amount",
    lambda lake: lake.raw("products").select(
        "product_name", c.non_negative("unit_price").alias("unit_price")
    ),
    "select product_name, greatest(coalesce(unit_price, 0), 0) as unit_price from raw_products",
)


@query(
    "b9_number_or_zero",
    """select doc_id, coalesce(try_cast(lang as double), 0.0) as from_text,
              cast(coalesce(try_cast(try_cast(n_chars as double) as int), 0) as int) as whole
       from documents""",
)
def numbers(lake: Lake) -> DataFrame:
    docs = lake.table("documents")
    text = docs.select("doc_id", "lang", F.col("n_chars").cast("string").alias("n_chars"))
    return text.select(
        "doc_id", c.number_or_zero("lang").alias("from_text"), c.whole_or_zero("n_chars").alias(
            "whole")
    )


register(
    "b10_parse_timestamp",
    lambda lake: lake.raw("orders").select(
        "order_id",
        c.timestamp("order_date").alias("order_ts"),
        c.timestamp("order_status").alias("not_a_timestamp"),
    ),
    """select order_id, cast(try_cast(order_date as timestamp) as string) as order_ts,
              cast(try_cast(order_status as timestamp) as string) as not_a_timestamp
       from raw_orders""",
)
register(
    "b11_parse_date",
    lambda lake: lake.raw("campaigns").select(
        "campaign_id", c.date("start_date").alias("start_date"), c.date("end_date").alias(
            "end_date")
    ),
    """select campaign_id, cast(try_cast(start_date as date) as string) as start_date,
              cast(try_cast(end_date as date) as string) as end_date from raw_campaigns""",
)


@query(
    "b12_status_validation",
    f"""select order_id, case when flag then status end as order_status, flag as is_valid_status
        from (select order_id, status, status in {STATUSES} as flag
              from (select order_id, {token('order_status')} as status from raw_orders))""",
)
def statuses(lake: Lake) -> DataFrame:
    status, flag = c.order_status_token("order_status")
    return lake.raw("orders").select(
        "order_id", status.alias("order_status"), flag.alias("is_valid_status")
    )


register(
    "b13_derived_money",
    lambda lake: lake.silver["order_items"].select(
        "order_item_id", "gross_amount", "net_amount", "is_quantity_valid"
    ),
    """select order_item_id, cast(gross_amount as double) as gross_amount,
              cast(net_amount as double) as net_amount, is_quantity_valid from s_order_items""",
)


@query(
    "b14_surrogate_key",
    " union all ".join(
        f"""select '{entity}' as entity, count(*) as key_rows, count(distinct {key}) as ids,
                   count(distinct {key}) as surrogate_keys, 0::bigint as out_of_range
            from raw_{entity}"""
        for entity, key in (
            ("customers", "customer_id"), ("orders", "order_id"),
            ("order_items", "order_item_id"), ("web_events", "event_id"),
        )
    ),
)
def surrogate_keys(lake: Lake) -> DataFrame:
    parts = []
    for entity in ("customers", "orders", "order_items", "web_events"):
        key = RAW_ENTITIES[entity].key
        keyed = lake.raw(entity).select(key, c.surrogate_key(key).alias("k"))
        parts.append(
            keyed.agg(
                F.count("*").alias("key_rows"),
                F.count_distinct(key).alias("ids"),
                F.count_distinct("k").alias("surrogate_keys"),
                F.count_if(F.col("k").isNull() | (F.col("k") < 0)).alias("out_of_range"),
            ).select(F.lit(entity).alias("entity"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


register(
    "b15_date_attributes",
    lambda lake: lake.table("lineitem")
    .select(c.date("l_shipdate").alias("day_seen"))
    .distinct()
    .select(*[e.alias(n) for n, e in c.date_attributes(F.col("day_seen")).items()]),
    """select cast(strftime(d, '%Y%m%d') as int) as date_key, cast(d as string) as full_date,
              cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
              cast(month(d) as int) as month, monthname(d) as month_name,
              cast(day(d) as int) as day, cast(dayofweek(d) + 1 as int) as day_of_week
       from (select distinct cast(l_shipdate as date) as d from lineitem)""",
)
register(
    "b16_label_fallback",
    lambda lake: lake.raw("web_events").select(
        "event_id",
        c.campaign_label("campaign_id").alias("campaign_label"),
        c.channel_label("campaign_id").alias("channel_label"),
    ),
    """select event_id, coalesce(campaign_id, 'unattributed') as campaign_label,
              coalesce(campaign_id, 'organic_or_unknown') as channel_label from raw_web_events""",
)


@query(
    "b17_null_measure_to_zero",
    """select product_id, coalesce(sold, 0) as sold
       from (select distinct product_id from s_products) left join
            (select product_id, count(*) as sold from s_order_items where quantity > 49
             group by product_id) using (product_id)""",
)
def zeros(lake: Lake) -> DataFrame:
    sold = (
        lake.silver["order_items"].filter("quantity > 49").groupBy("product_id").agg(
            F.count("*").alias("sold"))
    )
    products = lake.silver["products"].select("product_id").distinct()
    return products.join(sold, "product_id", "left").select(
        "product_id", c.zero_if_null("sold").alias("sold")
    )


register(
    "b18_round_two_places",
    lambda lake: lake.silver["order_items"].groupBy("product_id").agg(
        F.round(F.sum("net_amount"), 2).alias("total_revenue")
    ),
    """select product_id, cast(round(sum(net_amount), 2) as double) as total_revenue
       from s_order_items group by product_id""",
)
register(
    "b19_column_pruning",
    lambda lake: gold.valid_items(lake.silver["order_items"]).select(
        "order_item_id", "order_id", "product_id"
    ),
    "select order_item_id, order_id, product_id from s_order_items where is_quantity_valid",
)
register(
    "b20_rename_and_drop",
    lambda lake: lake.silver["web_events"]
    .withColumn("event_date", F.to_date("event_timestamp"))
    .withColumnRenamed("event_date", "sales_date")
    .drop("event_timestamp", "page", "device", "session_id", "event_type"),
    """select event_id, customer_id, campaign_id,
              cast(cast(event_timestamp as date) as string) as sales_date from s_web_events""",
)
register(
    "b21_quality_percentage",
    lambda lake: silver.marked("orders", lake.raw("orders"))
    .groupBy("customer_id")
    .agg(F.count("*").alias("n"), F.count_if(F.col(silver.DEFECT)).alias("bad"))
    .select("customer_id", c.percentage_valid(F.col("n"), F.col("bad")).alias("quality_pct")),
    """select customer_id, round(greatest(count(*) - count_if(defect), 0)::double / count(*) * 100,
              2) as quality_pct from m_orders group by customer_id""",
)

register(
    "b9_numbers_from_text",
    lambda lake: lake.table("lineitem").select(
        "l_orderkey", "l_linenumber",
        c.number_or_zero(F.concat(F.lit("  "), "l_linenumber", F.lit(".5 "))).alias("padded"),
        c.number_or_zero(F.concat(F.lit("-"), "l_linenumber")).alias("negative"),
        c.number_or_zero(F.concat("l_linenumber", F.lit("x"))).alias("broken")),
    """select l_orderkey, l_linenumber, l_linenumber + 0.5::double as padded,
              -l_linenumber::double as negative, 0::double as broken from lineitem""",
)
register(
    "b15_dates_with_dirt",
    lambda lake: lake.table("orders").select("o_orderkey", c.date(
        F.when(F.col("o_orderkey") % 7 == 0, "12345-01-01")
        .when(F.col("o_orderkey") % 7 == 1, "300000-01-01")
        .when(F.col("o_orderkey") % 7 == 2, "soon")
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))).alias("day")).withColumn(
            "date_key", c.date_key(F.col("day"))),
    """select o_orderkey, cast(day as string) as day,
              cast(strftime(day, '%Y%m%d') as int) as date_key
       from (select o_orderkey, case when o_orderkey % 7 > 2 then cast(o_orderdate as date) end as day
             from orders)""",
)

# --- C: filters -------------------------------------------------------------------------------

register(
    "c1_required_key",
    lambda lake: lake.raw("products").filter(c.has_text("product_id")).select("product_id"),
    "select product_id from raw_products where trim(product_id) <> ''",
)
register(
    "c2_valid_orders",
    lambda lake: gold.valid_orders(lake.silver["orders"]),
    """select order_id, customer_id, payment_method, order_status,
              cast(cast(order_date as date) as string) as sales_date
       from s_orders where is_valid_status and order_date is not null""",
)
register(
    "c3_valid_items",
    lambda lake: gold.valid_items(lake.silver["order_items"]),
    """select order_item_id, order_id, product_id, quantity,
              cast(gross_amount as double) as gross_amount, discount_amount,
              cast(net_amount as double) as net_amount
       from s_order_items where is_quantity_valid""",
)
register(
    "c4_valid_events",
    lambda lake: gold.valid_events(lake.silver["web_events"]).select("event_id", "event_type"),
    """select event_id, event_type from s_web_events where customer_id is not null
       and event_timestamp is not null and event_type is not null""",
)
register(
    "c5_attributable_events",
    lambda lake: attribution.attributable_events(lake.silver["web_events"]).select(
        "event_id", "campaign_id"
    ),
    """select event_id, campaign_id from s_web_events where campaign_id is not null
       and customer_id is not null and event_timestamp is not null""",
)
register(
    "c6_not_null_fact_rows",
    lambda lake: lake.star.fct_sales.filter(
        F.col("net_amount").isNotNull() & F.col("campaign_key").isNotNull()
    ).select("order_item_id", "net_amount"),
    """select order_item_id, cast(net_amount as double) as net_amount from g_sales
       where net_amount is not null and campaign_id is not null""",
)
register(
    "c7_silver_defects",
    lambda lake: reduce(
        DataFrame.unionByName,
        [
            silver.marked(name, lake.raw(name))
            .agg(F.count_if(F.col(silver.DEFECT)).alias("invalid_records"))
            .select(F.lit(name).alias("entity"), "invalid_records")
            for name in RAW_SQL
        ],
    ),
    " union all ".join(
        f"select '{n}' as entity, count_if(defect) as invalid_records from m_{n}" for n in RAW_SQL
    ),
)
INPUT_DEFECTS = {
    "customers": "coalesce(trim(customer_id), '') = ''",
    "products": "coalesce(trim(product_id), '') = ''",
    "campaigns": "coalesce(trim(campaign_id), '') = '' or start_date is null or end_date is null",
    "orders": "not coalesce(is_valid_status, false) or order_date is null",
    "order_items": "not is_quantity_valid or net_amount is null or net_amount < 0",
    "web_events": "customer_id is null or event_type is null or event_timestamp is null",
}
INPUT_SQL = " union all ".join(
    f"select '{n}' as entity, count(*) as records_in, count_if({p}) as invalid_records from s_{n}"
    for n, p in INPUT_DEFECTS.items()
)
register("c8_gold_input_defects", lambda lake: gold.input_counts(lake.silver), INPUT_SQL)
register(
    "c8_gold_input_total",
    lambda lake: gold.invalid_input_total(lake.silver),
    f"select cast(sum(invalid_records) as bigint) as invalid_records from ({INPUT_SQL})",
)

# --- D: joins ---------------------------------------------------------------------------------


@query(
    "d1_inner_join_same_name",
    """select i.order_item_id, i.order_id, o.customer_id, i.product_id
       from s_order_items i join s_orders o on i.order_id = o.order_id
            join s_customers c on c.customer_id = o.customer_id
            join s_products p on p.product_id = i.product_id""",
)
def inner_joins(lake: Lake) -> DataFrame:
    heads = joins.keep_known(
        lake.silver["orders"].select("order_id", "customer_id"),
        lake.silver["customers"], "customer_id",
    )
    items = joins.keep_known(
        lake.silver["order_items"].select("order_item_id", "order_id", "product_id"),
        lake.silver["products"], "product_id",
    )
    return items.join(heads, "order_id")


@query(
    "d2_inner_join_other_name",
    """select order_id, date_key from s_orders join g_dim_date
       on cast(order_date as date) = full_date""",
)
def calendar_join(lake: Lake) -> DataFrame:
    orders = lake.silver["orders"].select(
        "order_id", F.to_date("order_date").alias("sales_date")
    )
    days = broadcast_if_bounded(lake.tables["dim_date"].select("date_key", "full_date"))
    joined = orders.join(days, F.col("sales_date") == F.col("full_date"), "inner")
    return joined.drop("full_date", "sales_date")


@query(
    "d3_left_join_composite_key",
    """select o.order_id, o.customer_id, cast(cast(o.order_date as date) as string) as sales_date,
              t.campaign_id
       from s_orders o left join g_touch t on t.customer_id = o.customer_id
            and t.sales_date = cast(o.order_date as date)
       where o.is_valid_status""",
)
def composite_join(lake: Lake) -> DataFrame:
    heads = gold.valid_orders(lake.silver["orders"])
    touches = attribution.last_touch(lake.silver["web_events"])
    joined = joins.splittable_join(heads, touches, ["customer_id", "sales_date"], "left")
    return joined.select("order_id", "customer_id", "sales_date", "campaign_id")


register(
    "d4_left_join_lookup",
    lambda lake: joins.lookup_join(
        lake.silver["web_events"].select("event_id", "campaign_id"),
        lake.silver["campaigns"].select("campaign_id", "campaign_name"), ["campaign_id"], "left",
    ).select("event_id", "campaign_name"),
    """select event_id, campaign_name from s_web_events left join s_campaigns
       using (campaign_id)""",
)
register(
    "d4_left_join_null_spread",
    lambda lake: joins.splittable_join(
        lake.silver["web_events"].select("event_id", "campaign_id"),
        lake.silver["campaigns"].select("campaign_id", "campaign_name"), ["campaign_id"], "left",
    ).select("event_id", "campaign_name"),
    """select event_id, campaign_name from s_web_events left join s_campaigns
       using (campaign_id)""",
)
CATEGORY_REVENUE_SQL = """
    select category, cast(round(sum(net_amount), 2) as double) as total_revenue
    from g_sales join g_dim_product using (product_id) group by category"""
register(
    "d5_broadcast_join",
    lambda lake: marts.revenue_by_category_broadcast(lake.star),
    CATEGORY_REVENUE_SQL,
)
register(
    "d6_shuffle_join",
    lambda lake: marts.naive_queries(lake.star)["revenue_by_category"],
    CATEGORY_REVENUE_SQL,
)
register(
    "d7_scale_multiplier",
    lambda lake: marts.scaled(lake.star, 3).fct_sales.groupBy("order_status").agg(
        F.sum("net_amount").alias("revenue_net"),
        F.count("*").alias("sales_rows"),
        F.count_distinct("order_id").alias("total_orders"),
    ),
    """select order_status, cast(sum(net_amount) * 3 as double) as revenue_net,
              count(*) * 3 as sales_rows, count(distinct order_id) as total_orders
       from g_sales group by order_status""",
)
CAMPAIGN_SQL = """
    select c.campaign_id, c.campaign_name, c.channel, cast(c.budget as double) as budget,
           cast(coalesce(s.revenue_net, 0) as double) as revenue_net,
           cast(coalesce(s.revenue_gross, 0) as double) as revenue_gross,
           cast(coalesce(s.total_discount, 0) as double) as total_discount,
           coalesce(s.total_orders, 0) as total_orders,
           coalesce(e.total_events, 0) as total_events,
           coalesce(e.total_sessions, 0) as total_sessions
    from g_dim_campaign c
         left join (select campaign_id, sum(net_amount) as revenue_net,
                           sum(gross_amount) as revenue_gross,
                           sum(discount_amount) as total_discount,
                           count(distinct order_id) as total_orders
                    from g_sales group by campaign_id) s using (campaign_id)
         left join (select campaign_id, count(*) as total_events,
                           count(distinct session_id) as total_sessions
                    from g_events group by campaign_id) e using (campaign_id)"""
register(
    "d8_aggregate_then_join", lambda lake: marts.campaign_performance(lake.star), CAMPAIGN_SQL
)


@query(
    "d9_star_join",
    """select s.order_item_id, cast(s.full_date as string) as full_date, c.country, p.category,
              g.channel
       from g_sales s join g_dim_customer c using (customer_id)
            join g_dim_product p using (product_id)
            left join g_dim_campaign g on g.campaign_id = s.campaign_id""",
)
def star_join(lake: Lake) -> DataFrame:
    star = lake.star
    joined = star.fct_sales.join(
        broadcast_if_bounded(star.dim_date.select("date_key", "full_date")), "date_key"
    )
    for dim, key, attribute, how in (
        (star.dim_customer, "customer_key", "country", "inner"),
        (star.dim_product, "product_key", "category", "inner"),
        (star.dim_campaign, "campaign_key", "channel", "left"),
    ):
        joined = joins.lookup_join(joined, dim.select(key, attribute), [key], how)
    return joined.select("order_item_id", "full_date", "country", "category", "channel")


# --- E: aggregations --------------------------------------------------------------------------

register(
    "e1_grouped_sums",
    lambda lake: lake.silver["order_items"].groupBy("order_id").agg(
        F.sum("net_amount").alias("net"), F.sum("gross_amount").alias("gross"),
        F.sum(c.money(F.col("discount_amount"))).alias("discount"),
        F.sum("quantity").alias("quantity"),
    ),
    """select order_id, cast(sum(net_amount) as double) as net,
              cast(sum(gross_amount) as double) as gross,
              cast(sum(cast(discount_amount as decimal(18, 2))) as double) as discount,
              cast(sum(quantity) as bigint) as quantity from s_order_items group by order_id""",
)
register(
    "e2_grouped_count",
    lambda lake: lake.silver["web_events"].groupBy("campaign_id").agg(
        F.count("*").alias("total_events")),
    "select campaign_id, count(*) as total_events from s_web_events group by campaign_id",
)
register(
    "e3_count_distinct",
    lambda lake: lake.silver["orders"].groupBy("payment_method").agg(
        F.count_distinct("customer_id").alias("customers")),
    """select payment_method, count(distinct customer_id) as customers from s_orders
       group by payment_method""",
)
register(
    "e4_several_distincts",
    lambda lake: lake.silver["web_events"].groupBy("event_type").agg(
        F.count("*").alias("total_events"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.count_distinct("customer_id").alias("distinct_customers")),
    """select event_type, count(*) as total_events, count(distinct session_id) as total_sessions,
              count(distinct customer_id) as distinct_customers
       from s_web_events group by event_type""",
)
register(
    "e5_group_by_expression",
    lambda lake: lake.silver["web_events"]
    .groupBy(c.channel_label("campaign_id").alias("channel"))
    .agg(F.count("*").alias("total_events")),
    """select coalesce(campaign_id, 'organic_or_unknown') as channel, count(*) as total_events
       from s_web_events group by 1""",
)
register(
    "e6_multi_column_group",
    lambda lake: lake.silver["customers"].groupBy("country", "city", "state").agg(
        F.count("*").alias("customers"), F.count_if("is_email_valid").alias("reachable")),
    """select country, city, state, count(*) as customers, count_if(is_email_valid) as reachable
       from s_customers group by country, city, state""",
)
register(
    "e7_global_count",
    lambda lake: lake.table("lineitem").agg(F.count("*").alias("records")),
    "select count(*) as records from lineitem",
)
register(
    "e8_conditional_count",
    lambda lake: lake.silver["orders"].agg(
        F.count_if("is_valid_status").alias("valid_orders"),
        F.count_if(~F.col("is_valid_status")).alias("invalid_orders")),
    """select count_if(is_valid_status) as valid_orders, count_if(not is_valid_status)
           as invalid_orders from s_orders""",
)
register(
    "e9_having",
    lambda lake: lake.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("copies")).filter("copies > 1"),
    """select l_orderkey, l_linenumber, count(*) as copies from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1""",
)

# --- F, G, H ----------------------------------------------------------------------------------

register(
    "f1_one_row_per_key",
    lambda lake: dedup.latest_per_key(
        lake.table("lineitem").select(
            "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("ingestion_timestamp"),
            "l_partkey", "l_suppkey", "l_quantity",
        ),
        ["l_orderkey", "l_linenumber"],
    ),
    """select l_orderkey, l_linenumber, cast(l_shipdate as string) as ingestion_timestamp,
              l_partkey, l_suppkey, l_quantity from lineitem
       qualify row_number() over (partition by l_orderkey, l_linenumber
           order by l_shipdate desc, l_partkey, l_suppkey, l_quantity) = 1""",
)
register(
    "f2_distinct",
    lambda lake: lake.table("lineitem").select("l_orderkey", "l_linenumber").distinct(),
    "select distinct l_orderkey, l_linenumber from lineitem",
)
register(
    "f3_union_all",
    lambda lake: lake.silver["orders"].select(c.date("order_date").alias("full_date")).union(
        lake.silver["web_events"].select(c.date("event_timestamp").alias("full_date"))),
    """select cast(cast(order_date as date) as string) as full_date from s_orders union all
       select cast(cast(event_timestamp as date) as string) from s_web_events""",
)
register(
    "g1_last_touch",
    lambda lake: attribution.last_touch(lake.silver["web_events"]),
    """select customer_id, cast(sales_date as string) as sales_date, campaign_id from g_touch""",
)
register(
    "h1_global_sort",
    lambda lake: lake.star.fct_sales.select("order_item_id", "order_status", "net_amount").orderBy(
        "order_status", F.desc("net_amount"), "order_item_id"),
    """select order_item_id, order_status, cast(net_amount as double) as net_amount from g_sales
       order by order_status, net_amount desc, order_item_id""",
)
register(
    "h2_top_k",
    lambda lake: lake.silver["order_items"].select("order_item_id", "net_amount").orderBy(
        F.desc("net_amount"), "order_item_id").limit(25),
    """select order_item_id, cast(net_amount as double) as net_amount from s_order_items
       order by s_order_items.net_amount desc, order_item_id limit 25""",
)

# --- I: quality -------------------------------------------------------------------------------

RULE_SQL = {
    "customer_id_not_null": ("s_customers", "coalesce(trim(customer_id), '') = ''"),
    "product_id_not_null": ("s_products", "coalesce(trim(product_id), '') = ''"),
    "order_id_not_null": ("s_orders", "coalesce(trim(order_id), '') = ''"),
    "valid_quantity_positive": (
        "s_order_items", "is_quantity_valid is distinct from (quantity > 0)"),
    "valid_net_amount_non_negative": ("s_order_items", "is_quantity_valid and net_amount < 0"),
    "order_status_allowed": (
        "s_orders",
        f"""(order_status is not null and lower(order_status) not in {STATUSES})
            or (coalesce(is_valid_status, false) and order_status is null)"""),
    "invalid_email_flagged": (
        "s_customers",
        f"coalesce(regexp_matches(lower(email), '{EMAIL}'), false) <> is_email_valid"),
    "customer_key_not_null": ("g_dim_customer", "customer_id is null"),
    "product_key_not_null": ("g_dim_product", "product_id is null"),
    "campaign_key_not_null": ("g_dim_campaign", "campaign_id is null"),
    "date_key_not_null": ("g_dim_date", "date_key is null"),
    "fct_sales_required_dimension_keys": (
        "g_sales", "customer_id is null or product_id is null"),
    "net_amount_numeric": ("g_sales", "try_cast(net_amount as double) is null"),
}
UNIQUE_SQL = {"date_key_unique": ("g_dim_date", "date_key"),
              "order_item_id_unique": ("g_sales", "order_item_id")}


def result_sql(layer: str, entity: str, rule: str, counts: str) -> str:
    return f"""select '{layer}' as layer, '{entity}' as entity, '{rule}' as rule_name,
        total_records, failed_records, failed_records = 0 as passed,
        case when total_records = 0 then 100.0::double
             else round(greatest(total_records - failed_records, 0)::double / total_records * 100,
                        2) end as quality_percentage
        from ({counts})"""


def rule_counts(rule: quality.RowRule | quality.UniqueRule) -> str:
    if rule.name in RULE_SQL:
        table, failure = RULE_SQL[rule.name]
        return (f"select count(*) as total_records, count_if({failure}) as failed_records "
                f"from {table}")
    table, key = UNIQUE_SQL[rule.name]
    return repeated_counts(table, key)


def repeated_counts(table: str, key: str) -> str:
    return f"""select (select count(*) from {table}) as total_records, count(*) as failed_records
        from (select {key} from {table} group by {key} having count(*) > 1)"""


def rule_sql(rule: quality.RowRule | quality.UniqueRule) -> str:
    return result_sql(rule.layer, rule.entity, rule.name, rule_counts(rule))


IDS = ("i1", "i2", "i3", "i4", "i5", "i6", "i7", "i8", "i9", "i10", "i11", "i12a", "i12b", "i13",
       "i14")


def _single_rule(rule) -> Callable[[Lake], DataFrame]:
    def build(lake: Lake) -> DataFrame:
        tables = lake.silver if rule.layer == "silver" else lake.tables
        return quality.evaluate(tables, [rule]).drop("description")

    return build


for _id, _rule in zip(IDS, (*quality.SILVER_RULES, *quality.GOLD_RULES), strict=True):
    register(f"{_id}_{_rule.entity}_{_rule.name}", _single_rule(_rule), rule_sql(_rule))


def all_results(lake: Lake) -> DataFrame:
    return quality.evaluate(lake.silver, quality.SILVER_RULES).unionByName(
        quality.evaluate(lake.tables, quality.GOLD_RULES)
    )


ALL_RULES_SQL = " union all ".join(
    rule_sql(rule) for rule in (*quality.SILVER_RULES, *quality.GOLD_RULES)
)
register("i_all_rules_one_pass", lambda lake: all_results(lake).drop("description"), ALL_RULES_SQL)
register(
    "i15_quality_summary",
    lambda lake: quality.summary(all_results(lake)),
    f"""select count(*) as total_checks, count_if(passed) as passed_checks,
               count_if(not passed) as failed_checks from ({ALL_RULES_SQL})""",
)
register(
    "i16_raw_file_presence",
    lambda lake: quality.raw_file_presence(
        list_files(lake.spark, order_folders(lake)), [f"o_orderstatus={x}" for x in "FOPX"]
    ).drop("description"),
    """select 'raw' as layer, 'o_orderstatus=' || s.status as entity,
              'raw_file_presence' as rule_name, n as total_records, 1 - n as failed_records,
              n = 1 as passed, 100.0::double * n as quality_percentage
       from (select status, cast(status in (select o_orderstatus from orders) as bigint) as n
             from (values ('F'), ('O'), ('P'), ('X')) v(status)) s""",
)
register(
    "i18_silver_deduplication",
    lambda lake: quality.evaluate(lake.silver, quality.DEDUPLICATION_RULES).drop("description"),
    " union all ".join(
        result_sql("silver", rule.entity, rule.name,
                   repeated_counts(f"s_{rule.entity}", rule.key[0]))
        for rule in quality.DEDUPLICATION_RULES
    ),
)
register(
    "i18_repeated_item_keys",
    lambda lake: quality.evaluate(
        {"lineitem": lake.table("lineitem")},
        [quality.UniqueRule("raw", "lineitem", "line_key_unique", "", ("l_orderkey",
                                                                      "l_linenumber"))],
    ).drop("description"),
    result_sql("raw", "lineitem", "line_key_unique",
               repeated_counts("lineitem", "l_orderkey, l_linenumber")),
)


def integrity_sql(layer: str, child: str, key: str, parent: str, names: dict[str, str]) -> str:
    counts = f"""select count(*) as total_records,
        count_if({key} is not null and {key} not in (select {key} from {names[parent]}
                                                     where {key} is not null)) as failed_records
        from {names[child]}"""
    return result_sql(layer, child, "gold_fact_dimension_integrity", counts)


NATURAL = {"customer_key": "customer_id", "product_key": "product_id",
           "campaign_key": "campaign_id", "date_key": "date_key"}
G_NAMES = {name: f"g_{name}" for name in GOLD_TABLES} | {
    "fct_sales": "g_sales", "fct_web_events": "g_events"}
register(
    "i19_fact_dimension_integrity",
    lambda lake: quality.integrity(lake.tables).drop("description"),
    " union all ".join(
        integrity_sql("gold", child, NATURAL[key], parent, G_NAMES)
        for child, key, parent in quality.FACT_REFERENCES
    ),
)
SILVER_REFERENCES = (
    ("orders", "customer_id", "customers"), ("order_items", "product_id", "products"),
    ("order_items", "order_id", "orders"), ("web_events", "customer_id", "customers"),
    ("web_events", "campaign_id", "campaigns"),
)
register(
    "i19_silver_orphans",
    lambda lake: quality.integrity(lake.silver, SILVER_REFERENCES, "silver").drop("description"),
    " union all ".join(
        integrity_sql("silver", child, key, parent, {n: f"s_{n}" for n in RAW_SQL})
        for child, key, parent in SILVER_REFERENCES
    ),
)

# --- J: layers --------------------------------------------------------------------------------

TEXT_COLUMNS = {
    "campaigns": ("start_date", "end_date"),
    "orders": ("order_date",),
    "web_events": ("event_timestamp",),
    "dim_customer": ("created_at",),
    "dim_campaign": ("start_date", "end_date"),
    "dim_date": ("full_date",),
}
DOUBLE_COLUMNS = {"order_items": ("gross_amount", "net_amount"), "dim_product": ("unit_price",),
                  "dim_campaign": ("budget",)}


def comparable_sql(name: str, table: str, keep: str = "*") -> str:
    changes = [f"cast({n} as string) as {n}" for n in TEXT_COLUMNS.get(name, ())]
    changes += [f"cast({n} as double) as {n}" for n in DOUBLE_COLUMNS.get(name, ())]
    return f"select {keep} replace ({', '.join(changes)}) from {table}" if changes else (
        f"select {keep} from {table}")


def _silver_entity(name: str) -> Callable[[Lake], DataFrame]:
    return lambda lake: lake.silver[name]


for _i, _name in enumerate(("customers", "products", "campaigns", "orders", "order_items",
                            "web_events"), start=2):
    register(f"j{_i}_silver_{_name}", _silver_entity(_name), comparable_sql(_name, f"s_{_name}"))


def _dimension(name: str, key: str) -> Callable[[Lake], DataFrame]:
    """The dimension without its hash key, plus a check that the key is in range."""

    def build(lake: Lake) -> DataFrame:
        df = lake.tables[name]
        return df.withColumn("has_key", F.coalesce(F.col(key) >= 0, F.lit(False))).drop(key)

    return build


for _id, _name in (("j8", "dim_customer"), ("j9", "dim_product"), ("j10", "dim_campaign")):
    register(
        f"{_id}_{_name}",
        _dimension(_name, _name.replace("dim_", "") + "_key"),
        f"select *, true as has_key from ({comparable_sql(_name, 'g_' + _name)})",
    )
register("j11_dim_date", lambda lake: lake.tables["dim_date"],
         comparable_sql("dim_date", "g_dim_date"))


def natural_ids(fact: DataFrame, star: Star) -> DataFrame:
    """Surrogate keys resolved back to natural ids through the dimensions.

    Columns that nobody reads are to be dropped before: the left joins shuffle whole rows.
    """
    for dim, key in ((star.dim_customer, "customer_key"), (star.dim_product, "product_key"),
                     (star.dim_campaign, "campaign_key")):
        if key in fact.columns:
            pair = dim.select(key, key.replace("_key", "_id"))
            fact = joins.lookup_join(fact, pair, [key], "left").drop(key)
    return fact


register(
    "j12_fct_sales",
    lambda lake: natural_ids(lake.star.fct_sales.drop("sales_key"), lake.star),
    """select order_id, order_item_id, customer_id, product_id, campaign_id, date_key, quantity,
              cast(gross_amount as double) as gross_amount,
              cast(discount_amount as double) as discount_amount,
              cast(net_amount as double) as net_amount, payment_method, order_status
       from g_sales""",
)
register(
    "j12_sales_keys",
    lambda lake: lake.star.fct_sales.agg(
        F.count("*").alias("sales_rows"), F.count_distinct("sales_key").alias("sales_keys"),
        F.bool_and((F.col("sales_key") >= 0) & (F.col("sales_key") < c.KEY_SPACE)).alias(
            "in_range")),
    """select count(*) as sales_rows, count(distinct order_id || '/' || order_item_id) as sales_keys,
              true as in_range from g_sales""",
)
register(
    "j13_event_keys",
    lambda lake: lake.star.fct_web_events.agg(
        F.count("*").alias("event_rows"), F.count_distinct("event_key").alias("event_keys"),
        F.bool_and((F.col("event_key") >= 0) & (F.col("event_key") < c.KEY_SPACE)).alias(
            "in_range")),
    """select count(*) as event_rows, count(*) as event_keys, true as in_range from g_events""",
)
register(
    "j13_fct_web_events",
    lambda lake: natural_ids(lake.star.fct_web_events.drop("event_key"), lake.star),
    """select customer_id, campaign_id, date_key, event_type, page, device, session_id
       from g_events""",
)
register(
    "j14_silver_entity_stats",
    lambda lake: reduce(
        DataFrame.unionByName, [silver.entity_stats(name, lake.raw(name)) for name in RAW_SQL]),
    " union all ".join(
        f"""select '{n}' as entity, count(*) as records_in, count_if(keep) as records_out,
                   count_if(defect) as invalid_records,
                   round(greatest(count(*) - count_if(defect), 0)::double / count(*) * 100, 2)
                       as quality_percentage,
                   'processing_date' as partition_columns from m_{n}"""
        for n in RAW_SQL
    ),
)
register(
    "j15_gold_table_stats",
    lambda lake: gold.table_stats(lake.silver, lake.tables),
    " union all ".join(
        f"""select '{table}' as table_name,
                   {' + '.join(f'(select count(*) from s_{n})' for n in inputs)} as input_rows,
                   count(*) as output_rows from {G_NAMES[table]}"""
        for table, inputs in gold.INPUTS.items()
    ),
)

# --- K: analytical queries --------------------------------------------------------------------

REVENUE_SQL = """cast(sum(net_amount) as double) as revenue_net,
    cast(sum(gross_amount) as double) as revenue_gross,
    cast(sum(discount_amount) as double) as total_discount,
    cast(sum(quantity) as bigint) as units_sold"""
register(
    "k1_revenue_by_category",
    lambda lake: marts.revenue_by_category(lake.star),
    f"""select category, {REVENUE_SQL} from g_sales join g_dim_product using (product_id)
        group by category""",
)
register(
    "k2_revenue_by_month",
    lambda lake: marts.revenue_by_month(lake.star),
    f"""select year, month, month_name, {REVENUE_SQL}, count(distinct order_id) as total_orders
        from g_sales join g_dim_date using (date_key) group by year, month, month_name""",
)
register(
    "k3_top_customers",
    lambda lake: marts.top_customers(lake.star),
    """select * replace (cast(revenue_net as double) as revenue_net)
       from (select customer_id, customer_name, city, state, sum(net_amount) as revenue_net,
                    count(distinct order_id) as total_orders,
                    cast(sum(quantity) as bigint) as units_sold
             from g_sales join g_dim_customer using (customer_id)
             group by customer_id, customer_name, city, state
             order by revenue_net desc, total_orders desc, customer_id limit 20)""",
)
register(
    "k4_campaign_performance", lambda lake: marts.campaign_performance(lake.star), CAMPAIGN_SQL
)
register(
    "k5_events_by_channel",
    lambda lake: marts.events_by_channel(lake.star),
    """select coalesce(channel, 'organic_or_unknown') as channel, event_type,
              count(*) as total_events, count(distinct session_id) as total_sessions,
              count(distinct customer_id) as distinct_customers
       from g_events left join g_dim_campaign using (campaign_id) group by 1, 2""",
)
register("k6_dm_sales_overview", lambda lake: marts.sales_overview(lake.star), MART_SQL)
BENCH_SQL = {
    "revenue_by_category": CATEGORY_REVENUE_SQL,
    "revenue_by_month": """
        select year, month, month_name, cast(round(sum(net_amount), 2) as double) as total_revenue
        from g_sales join g_dim_date using (date_key) group by year, month, month_name""",
    "revenue_by_campaign": """
        select coalesce(campaign_name, 'unattributed') as campaign_name,
               cast(round(sum(net_amount), 2) as double) as total_revenue
        from g_sales left join g_dim_campaign using (campaign_id) group by 1""",
    "top_customers": """
        select * replace (cast(total_revenue as double) as total_revenue)
        from (select customer_id, customer_name, round(sum(net_amount), 2) as total_revenue,
                     count(distinct order_id) as order_count
              from g_sales join g_dim_customer using (customer_id)
              group by customer_id, customer_name
              order by total_revenue desc, order_count desc, customer_id limit 10)""",
}


def _bench(name: str, variant: Callable) -> Callable[[Lake], DataFrame]:
    return lambda lake: variant(lake.star)[name]


for _id, _name in zip(("k7", "k8", "k9", "k10"), BENCH_SQL, strict=True):
    register(f"{_id}_bench_{_name}", _bench(_name, marts.tuned_queries), BENCH_SQL[_name])
    register(f"{_id}_naive_{_name}", _bench(_name, marts.naive_queries), BENCH_SQL[_name])
register(
    "k1_revenue_by_category_in_range",
    lambda lake: marts.revenue_by_category(
        marts.between(lake.star, "2024-01-05", "2024-01-19")),
    f"""select category, {REVENUE_SQL} from g_sales join g_dim_product using (product_id)
        where full_date between date '2024-01-05' and date '2024-01-19' group by category""",
)

# --- L: run metrics and storage profile -------------------------------------------------------


def run_history(lake: Lake) -> DataFrame:
    """One run per payment method and order day, measured over all orders."""
    day = c.date("order_date").alias("day")
    counted = silver.marked("orders", lake.raw("orders")).groupBy("payment_method", day).agg(
        F.count("*").alias("records_in"),
        F.count_if(F.col(silver.DEFECT)).alias("invalid_records"),
    )
    invalid, total = F.col("invalid_records"), F.col("records_in")
    started = F.col("day").cast("timestamp")
    runs = counted.select(
        F.concat(F.lit("load_"), "payment_method").alias("job_name"),
        started.alias("started_at"),
        F.timestamp_add("SECOND", total.cast("int"), started).alias("finished_at"),
        total.cast("double").alias("duration_seconds"),
        "records_in",
        (total - invalid).alias("records_out"),
        "invalid_records",
        F.when(F.dayofmonth("day") % 7 == 0, "success").alias("explicit_status"),
        F.when(invalid * 25 > total, "too many defects").alias("error_message"),
    )
    status = runlog.status_of(invalid, F.col("explicit_status"), F.col("error_message"))
    return runs.withColumn("status", status)


register(
    "l2_status_derivation",
    lambda lake: run_history(lake).select("job_name", "started_at", "invalid_records", "status"),
    """select job_name, cast(started_at as string) as started_at, invalid_records, status
       from runs""",
)
register(
    "l3_history_summary",
    lambda lake: runlog.history_summary(run_history(lake)),
    """select count(*) as total_executions, count_if(status = 'success') as success_executions,
              count_if(status = 'warning') as warning_executions,
              count_if(status = 'failed') as failed_executions,
              (select job_name from runs order by started_at desc, job_name desc limit 1)
                  as last_job_name from runs""",
)
register(
    "l4_overall_status",
    lambda lake: runlog.overall_status(run_history(lake), all_results(lake)),
    f"""select r.*, q.*, case when executions = 0 and checks = 0 then 'not_started'
                              when failed_executions > 0 then 'failed'
                              when failed_checks > 0 or warning_executions > 0 then 'warning'
                              else 'success' end as overall_status
        from (select count(*) as executions, count_if(status = 'failed') as failed_executions,
                     count_if(status = 'warning') as warning_executions from runs) r,
             (select count(*) as checks, count_if(not passed) as failed_checks
              from ({ALL_RULES_SQL})) q""",
)
register(
    "l5_execution_window",
    lambda lake: runlog.execution_window(run_history(lake)),
    """select cast(min(started_at) as string) as started_at,
              cast(max(finished_at) as string) as finished_at from runs""",
)
register(
    "l5_latest_runs",
    lambda lake: runlog.latest_runs(run_history(lake)),
    """select job_name, status, duration_seconds, records_in, records_out, invalid_records
       from runs order by started_at desc, job_name limit 5""",
)
register(
    "l5_failed_checks",
    lambda lake: runlog.failed_checks(all_results(lake)),
    f"""select layer, entity, rule_name, failed_records from ({ALL_RULES_SQL}) where not passed
        order by layer, entity, rule_name limit 10""",
)
@query(
    "l6_artifact_sizes",
    """select 'o_orderstatus=' || o_orderstatus as artifact, 1 as file_count, true as has_bytes
       from orders group by o_orderstatus""",
)
def sizes_of_folders(lake: Lake) -> DataFrame:
    root = order_folders(lake)
    names = [f"{root}/o_orderstatus={status}" for status in ("F", "O", "P", "F", "none")]
    found = artifact_sizes(lake.spark, names)
    return found.select(
        F.substring_index("artifact", "/", -1).alias("artifact"), "file_count",
        (F.col("size_bytes") > 0).alias("has_bytes"))


@query(
    "l7_layer_storage_profile",
    """select layer, 'o_orderstatus=' || layer as folder, file_count,
              file_count as small_file_count, file_count > 0 as has_bytes from (
         select o_orderstatus as layer, 1 as file_count from orders group by o_orderstatus
         union all select 'none', 0)""",
)
def profile_of_folders(lake: Lake) -> DataFrame:
    root, layers = order_folders(lake), ("F", "O", "P", "none")
    roots = {layer: f"{root}/o_orderstatus={layer}" for layer in layers}
    large = storage_profile.ProfileParameters(small_file_bytes=2**50)
    found = storage_profile.layer_profile(list_layers(lake.spark, roots), layers, large, roots)
    return found.select(
        "layer", F.substring_index("path", "/", -1).alias("folder"), "file_count",
        "small_file_count", (F.col("total_size_bytes") > 0).alias("has_bytes"))


PROFILE = storage_profile.ProfileParameters(
    storage_cost_per_gb_month=1000.0, scan_cost_per_tb=900000.0, small_file_bytes=2500)


def document_profile(lake: Lake) -> DataFrame:
    """Documents read as a file listing: language as the layer, size in characters."""
    listing = lake.table("documents").select(
        F.col("lang").alias("layer"), F.col("doc_id").cast("string").alias("path"),
        F.col("n_chars").alias("length"),
    )
    return storage_profile.layer_profile(listing, ("de", "en", "es", "fr", "none"), PROFILE)


register(
    "l8_small_file_flag",
    document_profile,
    """select layer, file_count, total_size_bytes, small_file_count, average_file_size_bytes,
              small_file_ratio, has_small_files_problem from profile""",
)
ESTIMATE_COLUMNS = ("layer", "storage_cost", "scan_bytes", "scan_cost", "optimized_scan_bytes",
                    "optimized_scan_cost", "savings_bytes", "savings_cost")
register(
    "l9_storage_estimates",
    lambda lake: storage_profile.with_estimates(document_profile(lake), PROFILE).select(
        *ESTIMATE_COLUMNS),
    f"select {', '.join(ESTIMATE_COLUMNS)} from estimates",
)
register(
    "l10_profile_totals",
    lambda lake: storage_profile.profile_totals(
        storage_profile.with_estimates(document_profile(lake), PROFILE)
    ).withColumn("layers_with_small_files", F.array_join("layers_with_small_files", ",")),
    """select count(*) as total_layers, cast(sum(file_count) as bigint) as total_files,
              cast(sum(total_size_bytes) as bigint) as total_storage_bytes,
              round(sum(storage_cost), 6) as total_storage_cost,
              round(sum(scan_cost), 6) as total_scan_cost,
              round(sum(optimized_scan_cost), 6) as total_optimized_scan_cost,
              round(sum(savings_cost), 6) as total_savings_cost,
              coalesce(string_agg(layer, ',' order by layer)
                       filter (where has_small_files_problem), '') as layers_with_small_files
       from estimates""",
)

# --- M, O -------------------------------------------------------------------------------------

register(
    "m2_repartition_by_key",
    lambda lake: layout.spread_by_key(lake.star.fct_sales, "date_key").groupBy("date_key").agg(
        F.count("*").alias("sales_rows"), F.sum("net_amount").alias("net")),
    """select date_key, count(*) as sales_rows, cast(sum(net_amount) as double) as net
       from g_sales group by date_key""",
)
register(
    "m2_rebalance_for_write",
    lambda lake: layout.cluster_for_write(lake.star.fct_sales, ["date_key"]).select(
        "order_item_id", "date_key"),
    "select order_item_id, date_key from g_sales",
)
register(
    "m3_single_small_result",
    lambda lake: layout.single_file(marts.revenue_by_month(lake.star)).select(
        "year", "month", "revenue_net"),
    """select year, month, cast(sum(net_amount) as double) as revenue_net
       from g_sales join g_dim_date using (date_key) group by year, month""",
)


def hit_sql(key: str, table: str) -> str:
    return f"({key} % 33 = 0 or {key} = (select min({key}) from {table}))"


register(
    "o1_null_email",
    lambda lake: defects.null_email(
        lake.table("customer").select("c_custkey", F.col("c_name").alias("email")), "c_custkey"),
    f"""select c_custkey, case when {hit_sql('c_custkey', 'customer')} then null else c_name end
            as email from customer""",
)
register(
    "o1_invalid_status",
    lambda lake: defects.invalid_status(
        lake.table("orders").select("o_orderkey", F.col("o_orderstatus").alias("order_status")),
        "o_orderkey"),
    f"""select o_orderkey, case when {hit_sql('o_orderkey', 'orders')} then 'legacy_sync_error'
               else o_orderstatus end as order_status from orders""",
)
register(
    "o1_negative_quantity",
    lambda lake: defects.negative_quantity(
        lake.table("lineitem").select(
            "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity")), "l_orderkey"),
    f"""select l_orderkey, l_linenumber, case when {hit_sql('l_orderkey', 'lineitem')}
               then -abs(l_quantity) else l_quantity end as quantity from lineitem""",
)
register(
    "o1_null_campaign",
    lambda lake: defects.null_campaign(
        lake.table("events").select("event_id", F.col("props").alias("campaign_id")), "event_id"),
    f"""select event_id, case when {hit_sql('event_id', 'events')} then null else props end
            as campaign_id from events""",
)
