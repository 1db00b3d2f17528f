"""Equi joins that stay balanced when a key is hot, NULL or pre-partitioned."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LANE = "__lane"


_EXACT_TYPES = (
    T.StringType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.BooleanType(),
    T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BinaryType(),
)


def _hash_agrees(left: DataFrame, right: DataFrame, name: str) -> bool:
    """Whether equal keys are sure to have equal hashes: one exact type on both sides."""
    kind = left.schema[name].dataType
    return kind == right.schema[name].dataType and kind in _EXACT_TYPES


def splittable_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Shuffle join whose hot keys can always be split at run time.

    AQE splits an oversized partition only where both join inputs are plain shuffles. A side that
    ends in an aggregate or a window on the join key is not: its partitioning is reused and the
    hot partition stays whole. The extra lane column is a further join key that no upstream
    partitioning covers, so both sides are exchanged right before the join. It is a function of
    the key, hence equal on both sides, except for rows with a NULL key: those match nothing, and
    the lane spreads them over the cluster instead of piling them onto one task.

    Keys whose equality is wider than their hash (mixed types, floating point, collated text) are
    joined without a lane. All of this needs adaptive execution; a warning says if it is off.
    """
    conf = left.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") != "true":
        warnings.warn("hot keys are not split while spark.sql.adaptive.enabled is off", stacklevel=2)
    if not all(_hash_agrees(left, right, name) for name in on):
        return left.join(right, list(on), how)
    keys = [F.col(name) for name in on]
    # Several lanes for each reducer, so that NULL keys reach all of them evenly. A power of two and
    # a bit mask: a lane is never NULL, so that no filter on it is put below, with copies of all the
    # expressions that the columns stand for.
    last = 2 ** (8 * int(conf.get("spark.sql.shuffle.partitions"))).bit_length() - 1
    key_lane = F.xxhash64(*keys).bitwiseAND(last)
    lane = key_lane
    if how not in ("inner", "left_semi"):  # these drop rows with a NULL key before the shuffle
        null_key = reduce(Column.__or__, [key.isNull() for key in keys])
        row_lane = F.xxhash64(*[F.col(name) for name in left.columns]).bitwiseAND(last)
        # It reads all columns, so none that a caller leaves out later is pruned below the join.
        lane = F.when(null_key, row_lane).otherwise(key_lane)
    spread = left.withColumn(_LANE, lane)
    return spread.join(right.withColumn(_LANE, key_lane), [*on, _LANE], how).drop(_LANE)


def lookup_join(
    fact: DataFrame, dimension: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join a fact to a dimension. One plan shape: Catalyst and AQE broadcast a small dimension by
    its size, and hot keys of a large one can be split."""
    return splittable_join(fact, dimension, on, how)


def keep_known(fact: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose key occurs in ``members`` (an inner join to a unique lookup).

    A semi join needs no deduplicated lookup and carries no lookup columns. Ids are reduced on
    the map side first, so repeated members never pile up on one task.
    """
    return lookup_join(fact, members.select(key).distinct(), [key], "left_semi")


def lacking_keys(ids: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys of ``ids`` that ``members`` lacks. Keys are reduced on the map side, so
    what is shuffled is keys and never the rows that hold them."""
    keys = ids.select(key).filter(F.col(key).isNotNull()).distinct()
    return keys.join(members.select(key).distinct(), key, "left_anti")


def drop_lacking(fact: DataFrame, lacking: DataFrame, key: str) -> DataFrame:
    """``keep_known`` from the other side: rows whose key is neither NULL nor ``lacking``.

    Most facts refer to a large dimension with few keys missing there. Those few are broadcast where
    the dimension is too large for it, and the fact is not shuffled.
    """
    return lookup_join(fact.filter(F.col(key).isNotNull()), lacking, [key], "left_anti")


#: Bits that ``maybe_known`` marks, so that its broadcast is 8 MB however many members there are.
MARKS = 2**26


def maybe_known(fact: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose key occurs in ``members``, and a few others; NULL keys are dropped.

    To be put before the exact join of a large fact with a part of its keys that is too large for a
    broadcast: most rows without a partner are not shuffled. Hashes of the members are marked in
    ``MARKS`` bits. Members without number only let more rows pass.
    """
    place = F.pmod(F.xxhash64(key), F.lit(MARKS))
    spots = {"__bucket": F.bitmap_bucket_number(place), "__at": F.bitmap_bit_position(place)}
    marks = members.filter(F.col(key).isNotNull()).withColumns(spots).groupBy("__bucket").agg(
        F.bitmap_construct_agg("__at").alias("__marks"))
    byte = F.substring("__marks", F.shiftright("__at", 3).cast("int") + 1, F.lit(1))
    marked = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("__at") % 8).cast("int")) == 1
    met = fact.filter(F.col(key).isNotNull()).withColumns(spots).join(F.broadcast(marks), "__bucket")
    return met.filter(marked).select(*fact.columns)


def orphans(
    fact: DataFrame, key: str, members: DataFrame, member_key: str | None = None
) -> DataFrame:
    """Distinct non-NULL keys of ``fact`` without a member, with the number of fact rows.

    The fact is counted per key before the anti join, so a hot key crosses the network as one
    row per task.
    """
    per_key = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    known = members.select(F.col(member_key or key).alias(key)).distinct()
    return per_key.join(known, key, "left_anti")


def replicate(df: DataFrame, times: int) -> DataFrame:
    """Every row ``times`` times, generated in place: no join and no shuffle."""
    if times < 1:
        raise ValueError(f"the multiplier is at least 1, not {times}")
    if times == 1:
        return df
    copies = F.sequence(F.lit(1), F.lit(times))
    return df.withColumn("__copy", F.explode(copies)).drop("__copy")
