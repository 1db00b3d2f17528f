"""Refreshing the facts after a load: only the days that the new rows touch are built again.

New rows reach further than their own day. An item belongs to the day of its order, which may have
come long before. A late event changes the attribution of its customer's orders of that day. A
customer, product or campaign that comes late lets in orders, items and events that were left out.
Each way is followed from the new rows to days, with the keys of the new rows only. Rows of silver
are added and never changed, so a day can gain rows or attribution but not lose all of its rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import columns as c
from stratalake.operators.attribution import attributable_events
from stratalake.operators.joins import keep_known, maybe_known, splittable_join
from stratalake.plans import gold

DAY = "full_date"
#: Entities whose new rows reach each fact.
REACH = {
    "fct_sales": ("orders", "order_items", "web_events", "customers", "products", "campaigns"),
    "fct_web_events": ("web_events", "customers", "campaigns"),
}


def _event_days(events: DataFrame) -> DataFrame:
    return gold.valid_events(events).select(c.date("event_timestamp").alias(DAY))


def _order_days(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("sales_date").alias(DAY))


def _touch_days(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Days on which a customer of these events, seen on that day, has an order."""
    seen = attributable_events(events).select(
        "customer_id", F.to_date("event_timestamp").alias("sales_date")).distinct()
    return _order_days(splittable_join(orders, seen, ["customer_id", "sales_date"], "left_semi"))


def touched_event_days(
    silver: Mapping[str, DataFrame], added: Mapping[str, DataFrame]
) -> DataFrame:
    """(full_date) of the event partitions that the ``added`` rows of silver change."""
    events = silver["web_events"]
    ways = {
        "web_events": lambda new: _event_days(new),
        "customers": lambda new: _event_days(keep_known(events, new, "customer_id")),
        "campaigns": lambda new: _event_days(keep_known(events, new, "campaign_id")),
    }
    return _days(ways, added)


def touched_sales_days(
    silver: Mapping[str, DataFrame], added: Mapping[str, DataFrame]
) -> DataFrame:
    """(full_date) of the sales partitions that the ``added`` rows of silver change."""
    orders = gold.valid_orders(silver["orders"])
    events, items = silver["web_events"], silver["order_items"]
    ways = {
        "orders": lambda new: _order_days(gold.valid_orders(new)),
        "order_items": lambda new: _order_days(keep_known(orders, new, "order_id")),
        "web_events": lambda new: _touch_days(orders, new),
        "customers": lambda new: _order_days(keep_known(orders, new, "customer_id")),
        "products": lambda new: _order_days(
            keep_known(orders, keep_known(items, new, "product_id"), "order_id")),
        "campaigns": lambda new: _touch_days(orders, keep_known(events, new, "campaign_id")),
    }
    return _days(ways, added)


def _days(ways: Mapping, added: Mapping[str, DataFrame]) -> DataFrame:
    found = [way(added[entity]) for entity, way in ways.items() if entity in added]
    if not found:
        raise ValueError("no entity with added rows is given")
    return reduce(DataFrame.unionByName, found).where(F.col(DAY).isNotNull()).distinct()


def on_days(silver: Mapping[str, DataFrame], days: DataFrame) -> dict[str, DataFrame]:
    """Silver with the orders and events of ``days`` only, and the items of these orders. A few items
    of other orders remain, which the fact's join to the orders drops."""

    def of(name: str, column: str) -> DataFrame:
        dated = silver[name].withColumn("__day", c.date(column))
        return keep_known(dated, days.select(F.col(DAY).alias("__day")), "__day").drop("__day")

    orders = of("orders", "order_date")
    items = maybe_known(silver["order_items"], orders, "order_id")
    return dict(silver) | {
        "orders": orders, "web_events": of("web_events", "event_timestamp"), "order_items": items}
