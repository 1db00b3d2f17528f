"""Entity catalogue: raw columns and types, natural keys, gold columns and partitioning."""

from __future__ import annotations

from dataclasses import dataclass

# Domain lists and formats every layer must agree on.
ORDER_STATUSES = ("created", "paid", "shipped", "cancelled", "refunded")
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
RUN_STATUSES = ("success", "warning", "failed")
LAYERS = ("raw", "bronze", "silver", "gold")
LINEAGE_COLUMNS = ("ingestion_timestamp", "source_file", "processing_date")
UNATTRIBUTED = "unattributed"
UNKNOWN_CHANNEL = "organic_or_unknown"
UNKNOWN_CATEGORY = "unknown"

MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class RawEntity:
    """One source dataset: where it lies below the raw root and how its columns are typed."""

    name: str
    file_name: str
    fmt: str
    key: str
    columns: dict[str, str]


# Names, keys and types of the six source datasets.
RAW_ENTITIES = {
    entity.name: entity
    for entity in (
        RawEntity(
            "customers", "customers.csv", "csv", "customer_id",
            {"customer_id": "string", "customer_name": "string", "email": "string",
             "city": "string", "state": "string", "country": "string", "created_at": "string"},
        ),
        RawEntity(
            "products", "products.csv", "csv", "product_id",
            {"product_id": "string", "product_name": "string", "category": "string",
             "unit_price": "double", "created_at": "string"},
        ),
        RawEntity(
            "campaigns", "campaigns.csv", "csv", "campaign_id",
            {"campaign_id": "string", "campaign_name": "string", "channel": "string",
             "start_date": "string", "end_date": "string", "budget": "double"},
        ),
        RawEntity(
            "orders", "orders.csv", "csv", "order_id",
            {"order_id": "string", "customer_id": "string", "order_date": "string",
             "payment_method": "string", "order_status": "string"},
        ),
        RawEntity(
            "order_items", "order_items.csv", "csv", "order_item_id",
            {"order_item_id": "string", "order_id": "string", "product_id": "string",
             "quantity": "int", "unit_price": "double", "discount_amount": "double"},
        ),
        RawEntity(
            "web_events", "web_events.json", "json", "event_id",
            {"event_id": "string", "customer_id": "string", "session_id": "string",
             "event_type": "string", "page": "string", "event_timestamp": "string",
             "device": "string", "campaign_id": "string"},
        ),
    )
}


@dataclass(frozen=True)
class GoldTable:
    """One star-schema table: its columns in order and its partition columns on disk."""

    name: str
    columns: dict[str, str]
    partitioned_by: tuple[str, ...] = ()


# Columns, types and partitioning of the six star-schema tables.
GOLD_TABLES = {
    table.name: table
    for table in (
        GoldTable(
            "dim_customer",
            {"customer_key": "bigint", "customer_id": "string", "customer_name": "string",
             "email": "string", "city": "string", "state": "string", "country": "string",
             "created_at": "timestamp"},
        ),
        GoldTable(
            "dim_product",
            {"product_key": "bigint", "product_id": "string", "product_name": "string",
             "category": "string", "unit_price": MONEY},
        ),
        GoldTable(
            "dim_campaign",
            {"campaign_key": "bigint", "campaign_id": "string", "campaign_name": "string",
             "channel": "string", "start_date": "date", "end_date": "date", "budget": MONEY},
        ),
        GoldTable(
            "dim_date",
            {"date_key": "int", "full_date": "date", "year": "int", "quarter": "int",
             "month": "int", "month_name": "string", "day": "int", "day_of_week": "int"},
            ("year", "month"),
        ),
        GoldTable(
            "fct_sales",
            {"sales_key": "bigint", "order_id": "string", "order_item_id": "string",
             "customer_key": "bigint", "product_key": "bigint", "campaign_key": "bigint",
             "date_key": "int", "quantity": "int", "gross_amount": MONEY,
             "discount_amount": MONEY, "net_amount": MONEY, "payment_method": "string",
             "order_status": "string"},
            ("date_key",),
        ),
        GoldTable(
            "fct_web_events",
            {"event_key": "bigint", "customer_key": "bigint", "campaign_key": "bigint",
             "date_key": "int", "event_type": "string", "page": "string", "device": "string",
             "session_id": "string"},
            ("date_key",),
        ),
    )
}
