"""Same-day last-touch campaign attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.dedup import first_per_key


def attributable_events(events: DataFrame) -> DataFrame:
    return events.filter(
        F.col("campaign_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("event_timestamp").isNotNull()
    )


def last_touch(events: DataFrame) -> DataFrame:
    """(customer_id, sales_date, campaign_id): the day's last campaign event of each customer.

    Day-level on purpose: a touch after the order on the same day still counts.
    """
    touches = attributable_events(events).select(
        "customer_id",
        F.to_date("event_timestamp").alias("sales_date"),
        "event_timestamp",
        "event_id",
        "campaign_id",
    )
    newest_first = [F.col(name).desc() for name in ("event_timestamp", "event_id", "campaign_id")]
    return first_per_key(touches, ["customer_id", "sales_date"], newest_first).select(
        "customer_id", "sales_date", "campaign_id"
    )
