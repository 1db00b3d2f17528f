"""Controlled bad data for exercising the quality rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_EVERY = 33  # about three percent
DEFAULT_SHARE = 0.03
_LEVEL_BITS = 16


def inject(
    df: DataFrame, column: str, bad: Column, key: str, every: int = DEFAULT_EVERY
) -> DataFrame:
    """Replace ``column`` by ``bad`` on every ``every``-th integer key and on the smallest key.

    The choice depends on the key alone, so reruns and retried tasks hit the same rows, and a
    non-empty table always gets at least one defect.
    """
    smallest = df.agg(F.min(key)).scalar()
    hit = (F.pmod(F.col(key), F.lit(every)) == 0) | (F.col(key) == smallest)
    value = F.when(hit, bad).otherwise(F.col(column)).cast(df.schema[column].dataType)
    return df.withColumn(column, value)


def null_email(customers: DataFrame, key: str, column: str = "email") -> DataFrame:
    return inject(customers, column, F.lit(None), key)


def invalid_status(orders: DataFrame, key: str, column: str = "order_status") -> DataFrame:
    return inject(orders, column, F.lit("legacy_sync_error"), key)


def negative_quantity(items: DataFrame, key: str, column: str = "quantity") -> DataFrame:
    return inject(items, column, -F.abs(F.col(column)), key)


def null_campaign(events: DataFrame, key: str, column: str = "campaign_id") -> DataFrame:
    return inject(events, column, F.lit(None), key)


def _border(df: DataFrame, k: int) -> tuple[int, int]:
    """The hash with the ``k``-th smallest place, and how many rows with it belong to the ``k``.

    Each pass counts the rows by the next sixteen bits of the hash among those that agree with the
    border so far; a pass returns at most 65 536 counts.
    """
    prefix, left = 0, k
    for level in range(64 - _LEVEL_BITS, -1, -_LEVEL_BITS):
        part = F.shiftrightunsigned("_hash", level)
        within = df if level == 64 - _LEVEL_BITS else df.where(
            F.shiftrightunsigned("_hash", level + _LEVEL_BITS) == prefix)
        counts = within.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
        for row in sorted(counts, key=lambda row: row["part"] % 2**64):
            if row["n"] >= left:
                prefix = row["part"]
                break
            left -= row["n"]
    return prefix, left


def exact_share(
    df: DataFrame, key: Sequence[str], share: float = DEFAULT_SHARE, seed: int = 42
) -> DataFrame:
    """``df`` with the column ``is_chosen``: true for exactly ``max(1, round(share * rows))`` rows.

    The rows with the smallest hashes of their key are chosen, so reruns choose the same ones and no
    sort is needed. Rows that tie at the border are taken in the order of all their columns.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *key))
    rows = hashed.count()
    k = min(rows, max(1, round(share * rows)))
    if not k:
        return df.withColumn("is_chosen", F.lit(False))
    border, left = _border(hashed, k)
    # Hashes are ordered as unsigned numbers: the sign bit flipped orders them as signed ones.
    order = F.col("_hash").bitwiseXOR(-(2**63))
    edge = border ^ -(2**63)
    at_border = Window.partitionBy("_hash").orderBy(*[F.col(name) for name in df.columns])
    tied = hashed.where(F.col("_hash") == border).withColumn(
        "is_chosen", F.row_number().over(at_border) <= left)
    others = hashed.where(F.col("_hash") != border).withColumn("is_chosen", order < edge)
    return others.unionByName(tied).drop("_hash")


def inject_share(
    df: DataFrame, column: str, bad: Column, key: Sequence[str], share: float = DEFAULT_SHARE
) -> DataFrame:
    """Replace ``column`` by ``bad`` in exactly that share of the rows, one at least."""
    value = F.when(F.col("is_chosen"), bad).otherwise(F.col(column)).cast(
        df.schema[column].dataType)
    return exact_share(df, key, share).withColumn(column, value).drop("is_chosen")
