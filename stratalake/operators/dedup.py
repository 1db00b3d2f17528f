"""Deterministic one-row-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Spark limits each map task to one row per key before the shuffle (WindowGroupLimit), so a key
    that holds most of the table still reaches the reducer as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the newest ingestion, ties broken by the remaining columns.

    Among rows that agree on every column it makes no difference which one stays, so the result
    does not depend on task order.
    """
    order = []
    if "ingestion_timestamp" in df.columns:
        order.append(F.col("ingestion_timestamp").desc())
    rest = [name for name in df.columns if name not in (*keys, "ingestion_timestamp")]
    order.extend(F.col(name).asc_nulls_last() for name in rest)
    return first_per_key(df, keys, order or [F.lit(0)])
