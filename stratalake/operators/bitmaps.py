"""Exact distinct counts that can be merged: bitmaps over dense numbers.

A bitmap of 4 KB holds which of 32 768 neighbouring numbers occur. Bitmaps stored per day are merged
to any period without going back to the fact, and several counts need no expanded rows: each is an
aggregate of its own small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "bucket", "bits"


def distinct_bitmaps(fact: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """(by, bucket, bits): which ``number`` values occur in each group; NULLs are left out."""
    return fact.where(F.col(number).isNotNull()).groupBy(
        *by, F.bitmap_bucket_number(number).alias(BUCKET)
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS))


def merged(bitmaps: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """The bitmaps of wider groups; ``bitmaps`` may come from several loads."""
    return bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """(by, name): the number of distinct values in each group."""
    found = merged(bitmaps, by)
    return found.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(name))
