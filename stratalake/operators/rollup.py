"""Fact roll-ups by dimension attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums_by_attribute(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    attributes: Sequence[Column | str],
    sums: dict[str, str],
    how: str = "inner",
) -> DataFrame:
    """``sum(column) as name`` for each entry of ``sums``, grouped by dimension attributes.

    The fact is first summed per key: the partial sums shrink a hot key to one row per task before
    any shuffle, and the join then runs on keys rather than on fact rows. Keys are unique by then, so
    a plain join cannot meet a hot one, and it keeps the aggregate's partitioning.
    """
    per_key = fact.groupBy(key).agg(*[F.sum(column).alias(name) for name, column in sums.items()])
    joined = per_key.join(dimension, key, how)
    types = {name: per_key.schema[name].dataType for name in sums}
    totals = [F.sum(name).cast(types[name]).alias(name) for name in sums]
    return joined.groupBy(*attributes).agg(*totals)
