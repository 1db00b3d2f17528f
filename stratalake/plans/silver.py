"""Bronze -> silver: one declarative refinement per entity, no actions and no shuffle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import columns as c
from stratalake.schemas import UNKNOWN_CATEGORY

PARTITION_COLUMNS = ("processing_date",)
DEFECT = "__defect"


@dataclass(frozen=True)
class Refinement:
    """How one entity is refined.

    ``raw_defect`` sees the bronze values, ``clean`` replaces columns, ``derive`` adds columns over
    the cleaned ones, ``defect`` sees the result, ``keep`` names the rows that stay.
    """

    clean: Callable[[], dict[str, Column]]
    derive: Callable[[], list[dict[str, Column]]] = list
    raw_defect: Callable[[], Column] = lambda: F.lit(False)
    defect: Callable[[], Column] = lambda: F.lit(False)
    keep: Callable[[], Column] | None = None


def _customers() -> Refinement:
    return Refinement(
        clean=lambda: {
            "customer_id": c.trimmed("customer_id"),
            "email": c.email_address("email"),
        },
        derive=lambda: [{"is_email_valid": c.is_email("email")}],
        defect=lambda: c.lacks_text("customer_id") | ~F.col("is_email_valid"),
        keep=lambda: c.has_text("customer_id"),
    )


def _products() -> Refinement:
    return Refinement(
        clean=lambda: {
            "product_id": c.trimmed("product_id"),
            "category": c.blank_as("category", c.token("category"), UNKNOWN_CATEGORY),
            "unit_price": c.non_negative("unit_price"),
        },
        raw_defect=lambda: c.below_zero_or_null("unit_price"),
        defect=lambda: c.lacks_text("product_id"),
        keep=lambda: c.has_text("product_id"),
    )


def _campaigns() -> Refinement:
    return Refinement(
        clean=lambda: {
            "start_date": c.date("start_date"),
            "end_date": c.date("end_date"),
            "budget": c.non_negative("budget"),
        },
        raw_defect=lambda: c.below_zero_or_null("budget"),
        defect=lambda: F.col("start_date").isNull() | F.col("end_date").isNull(),
    )


def _orders() -> Refinement:
    def clean() -> dict[str, Column]:
        status, flag = c.order_status_token("order_status")
        return {
            "order_date": c.timestamp("order_date"),
            "is_valid_status": flag,
            "order_status": status,
        }

    # A NULL status has a NULL flag, which is not counted as a defect here.
    return Refinement(
        clean=clean, defect=lambda: ~F.col("is_valid_status") | F.col("order_date").isNull()
    )


def _order_items() -> Refinement:
    return Refinement(
        clean=lambda: {
            "quantity": c.whole_or_zero("quantity"),
            "unit_price": c.number_or_zero("unit_price"),
            "discount_amount": c.number_or_zero("discount_amount"),
        },
        derive=lambda: [
            {
                "is_quantity_valid": F.col("quantity") > 0,
                "gross_amount": c.gross_amount(F.col("quantity"), F.col("unit_price")),
            },
            {"net_amount": c.net_amount(F.col("gross_amount"), F.col("discount_amount"))},
        ],
        defect=lambda: ~F.col("is_quantity_valid"),
    )


def _web_events() -> Refinement:
    return Refinement(
        clean=lambda: {
            "event_type": c.blank_as("event_type", c.token("event_type")),
            "event_timestamp": c.timestamp("event_timestamp"),
        },
        defect=lambda: F.col("event_type").isNull() | F.col("event_timestamp").isNull(),
    )


REFINEMENTS: dict[str, Refinement] = {
    "customers": _customers(),
    "products": _products(),
    "campaigns": _campaigns(),
    "orders": _orders(),
    "order_items": _order_items(),
    "web_events": _web_events(),
}


def standardise_lineage(df: DataFrame) -> DataFrame:
    """Type the lineage columns where the frame has them."""
    casts = {
        "ingestion_timestamp": c.timestamp,
        "processing_date": c.date,
        "source_file": lambda name: F.col(name).cast("string"),
    }
    return df.withColumns({name: cast(name) for name, cast in casts.items() if name in df.columns})


def marked(entity: str, bronze: DataFrame) -> DataFrame:
    """All bronze rows refined, with a boolean defect marker; nothing is dropped yet."""
    rule = REFINEMENTS[entity]
    refined = standardise_lineage(bronze)
    refined = refined.withColumns({DEFECT: rule.raw_defect(), **rule.clean()})
    for step in rule.derive():
        refined = refined.withColumns(step)
    return refined.withColumn(DEFECT, F.col(DEFECT) | rule.defect())


def settled(entity: str, frame: DataFrame) -> DataFrame:
    """Drop the rows that may not enter silver, and the marker."""
    keep = REFINEMENTS[entity].keep
    return (frame.filter(keep()) if keep else frame).drop(DEFECT)


def silver(entity: str, bronze: DataFrame) -> DataFrame:
    return settled(entity, marked(entity, bronze))


def entity_stats(entity: str, bronze: DataFrame) -> DataFrame:
    """One row: rows in, rows out, defects, valid percentage, partition columns; one pass."""
    keep = REFINEMENTS[entity].keep
    kept = F.count_if(keep()) if keep else F.count("*")
    counts = marked(entity, bronze).agg(
        F.count("*").alias("records_in"),
        kept.alias("records_out"),
        F.count_if(F.col(DEFECT)).alias("invalid_records"),
    )
    return counts.select(
        F.lit(entity).alias("entity"),
        "records_in",
        "records_out",
        "invalid_records",
        c.percentage_valid(F.col("records_in"), F.col("invalid_records")).alias(
            "quality_percentage"
        ),
        F.lit(",".join(PARTITION_COLUMNS)).alias("partition_columns"),
    )
