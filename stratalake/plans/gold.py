"""Silver -> gold: dimensions and facts of the star schema. No actions in here."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import columns as c
from stratalake.operators.attribution import last_touch
from stratalake.operators.dedup import latest_per_key
from stratalake.operators.joins import drop_lacking, keep_known, lookup_join, splittable_join
from stratalake.schemas import GOLD_TABLES, MONEY, RAW_ENTITIES


def _unique(silver: DataFrame, key: str) -> DataFrame:
    return latest_per_key(silver.filter(c.has_text(key)), [key])


def _finish(table: str, df: DataFrame) -> DataFrame:
    return df.select(*GOLD_TABLES[table].columns)


def dim_customer(customers: DataFrame) -> DataFrame:
    keyed = _unique(customers, "customer_id").withColumns(
        {
            "customer_key": c.surrogate_key("customer_id"),
            "created_at": c.timestamp("created_at"),
        }
    )
    return _finish("dim_customer", keyed)


def dim_product(products: DataFrame) -> DataFrame:
    keyed = _unique(products, "product_id").withColumns(
        {
            "product_key": c.surrogate_key("product_id"),
            "unit_price": F.col("unit_price").try_cast(MONEY),
        }
    )
    return _finish("dim_product", keyed)


def dim_campaign(campaigns: DataFrame) -> DataFrame:
    keyed = _unique(campaigns, "campaign_id").withColumns(
        {
            "campaign_key": c.surrogate_key("campaign_id"),
            "start_date": c.date("start_date"),
            "end_date": c.date("end_date"),
            "budget": F.col("budget").try_cast(MONEY),
        }
    )
    return _finish("dim_campaign", keyed)


def seen_dates(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct days with an order (valid or not) or an event."""
    order_days = orders.select(c.date("order_date").alias("full_date"))
    event_days = events.select(c.date("event_timestamp").alias("full_date"))
    return order_days.union(event_days).filter(F.col("full_date").isNotNull()).distinct()


def dim_date(orders: DataFrame, events: DataFrame) -> DataFrame:
    days = seen_dates(orders, events)
    return _finish("dim_date", days.withColumns(c.date_attributes(F.col("full_date"))))


def valid_orders(orders: DataFrame) -> DataFrame:
    """Valid status and a date. Cancelled and refunded are valid statuses and count as sales."""
    flag = F.coalesce(F.col("is_valid_status"), F.lit(False))
    return orders.filter(flag & F.col("order_date").isNotNull()).select(
        "order_id",
        "customer_id",
        "payment_method",
        "order_status",
        c.date("order_date").alias("sales_date"),
    )


def valid_items(items: DataFrame) -> DataFrame:
    return items.filter(F.coalesce(F.col("is_quantity_valid"), F.lit(False))).select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        *[c.money(F.col(name)).alias(name) for name in (
            "gross_amount", "discount_amount", "net_amount")],
    )


def valid_events(events: DataFrame) -> DataFrame:
    return events.filter(
        F.col("customer_id").isNotNull()
        & F.col("event_timestamp").isNotNull()
        & F.col("event_type").isNotNull()
    )


def known_campaign(frame: DataFrame, campaigns: DataFrame) -> DataFrame:
    """``campaign_id`` kept where the campaign exists, NULL otherwise; no row is added or lost."""
    known = campaigns.select(
        "campaign_id", F.col("campaign_id").alias("__known")
    ).filter(F.col("campaign_id").isNotNull()).distinct()
    checked = lookup_join(frame, known, ["campaign_id"], "left")
    return checked.withColumn("campaign_id", F.col("__known")).drop("__known")


def on_calendar(frame: DataFrame, calendar: DataFrame, day: str) -> DataFrame:
    """Rows whose day is in the calendar, which Catalyst broadcasts by its size."""
    days = calendar.select(F.col("full_date").alias(day))
    return keep_known(frame, days, day)


def order_heads(
    orders: DataFrame,
    customers: DataFrame,
    touches: DataFrame,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Valid orders of known customers with their keys and the last-touch campaign.

    Everything that depends on the order alone is settled here, on the narrow side, so the item
    lines are shuffled by order only once. ``calendar`` may be left out: ``dim_date`` holds every
    order date by construction.
    """
    heads = keep_known(valid_orders(orders), customers, "customer_id")
    if calendar is not None:
        heads = on_calendar(heads, calendar, "sales_date")
    heads = splittable_join(heads, touches, ["customer_id", "sales_date"], "left")
    return heads.select(
        "order_id",
        c.surrogate_key("customer_id").alias("customer_key"),
        optional_key("campaign_id").alias("campaign_key"),
        c.date_key(F.col("sales_date")).alias("date_key"),
        "payment_method",
        "order_status",
    )


def optional_key(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), c.surrogate_key(name))


def with_product_key(frame: DataFrame) -> DataFrame:
    """``frame`` with the key of the product in place of its id."""
    return frame.withColumn(
        "product_key", F.when(F.col("product_id").isNotNull(), c.surrogate_key("product_id"))
    ).drop("product_id")


def fct_sales(
    silver: Mapping[str, DataFrame],
    customers: DataFrame,
    products: DataFrame,
    campaigns: DataFrame,
    calendar: DataFrame | None = None,
    lacking: DataFrame | None = None,
) -> DataFrame:
    """One row per valid item of a valid order with a known customer and product.

    Dimension frames only prove that a member exists: keys are recomputed from the natural ids, so
    no dimension column travels through a join. Products are settled after the orders have thinned
    the items, on 8-byte keys: so much smaller a set of members is broadcast for far larger
    catalogues, and items are shuffled by order only. ``lacking`` are the product keys of items that
    ``products`` lacks, where the caller has stored them: they stay few when the catalogue is large.
    """
    touches = known_campaign(last_touch(silver["web_events"]), campaigns)
    heads = order_heads(silver["orders"], customers, touches, calendar)
    items = with_product_key(valid_items(silver["order_items"]))
    # Both sides are facts: never build one in memory, sort-merge spills and splits hot orders.
    lines = items.join(heads.hint("merge"), "order_id", "inner")
    if lacking is None:
        known = products.select(c.surrogate_key("product_id").alias("product_key"))
        lines = keep_known(lines, known, "product_key")
    else:
        lines = drop_lacking(lines, lacking, "product_key")
    return _finish(
        "fct_sales", lines.withColumn("sales_key", c.surrogate_key("order_id", "order_item_id"))
    )


def fct_web_events(
    silver: Mapping[str, DataFrame],
    customers: DataFrame,
    campaigns: DataFrame,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """The web-event fact: valid events of known customers, campaign optional."""
    events = valid_events(silver["web_events"]).withColumn(
        "event_date", c.date("event_timestamp")
    )
    events = keep_known(events, customers, "customer_id")
    if calendar is not None:
        events = on_calendar(events, calendar, "event_date")
    keyed = known_campaign(events, campaigns).withColumns(
        {
            "event_key": c.surrogate_key("event_id", "session_id", "event_timestamp"),
            "customer_key": c.surrogate_key("customer_id"),
            "campaign_key": optional_key("campaign_id"),
            "date_key": c.date_key(F.col("event_date")),
        }
    )
    return _finish("fct_web_events", keyed)


def star_builders(silver: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """One builder per gold table, so that a caller plans only the tables it reads."""

    def members(entity: str) -> DataFrame:
        return silver[entity].filter(c.has_text(RAW_ENTITIES[entity].key))

    return {
        "dim_customer": lambda: dim_customer(silver["customers"]),
        "dim_product": lambda: dim_product(silver["products"]),
        "dim_campaign": lambda: dim_campaign(silver["campaigns"]),
        "dim_date": lambda: dim_date(silver["orders"], silver["web_events"]),
        "fct_sales": lambda: fct_sales(
            silver, members("customers"), members("products"), members("campaigns")
        ),
        "fct_web_events": lambda: fct_web_events(
            silver, members("customers"), members("campaigns")
        ),
    }


def build_star(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All six tables as lazy frames over the six silver entities."""
    return {name: build() for name, build in star_builders(silver).items()}


# --- input counters ---------------------------------------------------------------------------

# Which silver entities feed each table; the date dimension counts both of its sources.
INPUTS = {
    "dim_customer": ("customers",),
    "dim_product": ("products",),
    "dim_campaign": ("campaigns",),
    "dim_date": ("orders", "web_events"),
    "fct_sales": ("order_items",),
    "fct_web_events": ("web_events",),
}


def _input_defects() -> dict[str, Column]:
    """Rows the gold layer counts as invalid. A NULL status flag counts here."""
    return {
        "customers": c.lacks_text("customer_id"),
        "products": c.lacks_text("product_id"),
        "campaigns": c.lacks_text("campaign_id")
        | F.col("start_date").isNull()
        | F.col("end_date").isNull(),
        "orders": ~F.coalesce(F.col("is_valid_status"), F.lit(False))
        | F.col("order_date").isNull(),
        "order_items": ~F.coalesce(F.col("is_quantity_valid"), F.lit(False))
        | F.col("net_amount").isNull()
        | (F.col("net_amount") < 0),
        "web_events": F.col("customer_id").isNull()
        | F.col("event_type").isNull()
        | F.col("event_timestamp").isNull(),
    }


def input_counts(silver: Mapping[str, DataFrame]) -> DataFrame:
    """(entity, records_in, invalid_records) for all silver entities: one pass over each."""
    defects = _input_defects()
    counts = [
        silver[name]
        .agg(F.count("*").alias("records_in"), F.count_if(defect).alias("invalid_records"))
        .select(F.lit(name).alias("entity"), "records_in", "invalid_records")
        for name, defect in defects.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def invalid_input_total(silver: Mapping[str, DataFrame]) -> DataFrame:
    return input_counts(silver).agg(F.sum("invalid_records").alias("invalid_records"))


def table_stats(silver: Mapping[str, DataFrame], star: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, input_rows, output_rows) per gold table."""
    counts = reduce(
        DataFrame.unionByName,
        [
            silver[entity].agg(F.count("*").alias("input_rows")).select(
                F.lit(entity).alias("entity"), "input_rows"
            )
            for entity in dict.fromkeys(name for names in INPUTS.values() for name in names)
        ],
    )
    needs = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(entity).alias("entity"))
        for table, entities in INPUTS.items() for entity in entities
    ])
    # An entity that feeds two tables is counted once.
    rows_in = counts.sparkSession.range(1).select(F.inline(needs)).join(counts, "entity")
    rows_out = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("output_rows")).select(
                F.lit(name).alias("table_name"), "output_rows"
            )
            for name, df in star.items()
        ],
    )
    totals = rows_in.groupBy("table_name").agg(F.sum("input_rows").alias("input_rows"))
    return totals.join(rows_out, "table_name")
