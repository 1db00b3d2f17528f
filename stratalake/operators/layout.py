"""Physical layout: writes, partitioning, caching and small results."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel


def spread_by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Bring rows of one key together without making one task own a hot key.

    The rebalance hint lets AQE split a hot key over several tasks and merge small ones, where a
    plain ``repartition(key)`` would leave a third of the table in one task.
    """
    return df.hint("rebalance", *keys)


def cluster_for_write(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Layout for a partitioned write: files near the advisory size for hot and cold values."""
    return spread_by_key(df, *partition_columns) if partition_columns else df


def range_buckets(df: DataFrame, columns: Sequence[str], bits: int = 6) -> dict[str, Column]:
    """For each column the number, below ``2**bits``, of the range its value lies in.

    Ranges hold about as many rows each; NULL lies in the first. The borders are approximate
    percentiles, ``2**bits - 1`` of them for each column.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    borders = df.agg(*[F.percentile_approx(name, shares, 100 * 2**bits).alias(name)
                       for name in columns]).first()

    def bucket(name: str) -> Column:
        kind = df.schema[name].dataType.simpleString()
        found = F.array(*[F.lit(value) for value in sorted(set(borders[name] or []))])
        return F.size(F.filter(found.cast(f"array<{kind}>"), lambda border: border <= F.col(name)))

    return {name: bucket(name) for name in columns}


def interleaved(buckets: Sequence[Column], bits: int) -> Column:
    """One number with the bits of all buckets in turn, the most significant ones first."""
    found = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, bucket in enumerate(reversed(buckets)):
            one = F.shiftright(bucket, bit).bitwiseAND(1).cast("bigint")
            found = found + F.shiftleft(one, bit * len(buckets) + place)
    return found


def cluster_by_ranges(
    df: DataFrame, columns: Sequence[str], files: int, bits: int = 6
) -> DataFrame:
    """Rows near each other in all ``columns`` share a file, so a filter on any one of them skips
    most files and row groups by their statistics. Numbers, dates and timestamps only."""
    buckets = range_buckets(df, columns, bits)
    curve = interleaved(list(buckets.values()), bits)
    return df.withColumn("__curve", curve).repartitionByRange(files, "__curve").sortWithinPartitions(
        "__curve").drop("__curve")


def write_entity(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str] = (),
    keep_other_partitions: bool = False,
) -> None:
    """Parquet overwrite, zstd: a third less than snappy for these tables. By default the whole dataset is replaced, as a full reload expects;
    ``keep_other_partitions`` replaces only the partition values present in ``df``."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_columns:
        mode = "dynamic" if keep_other_partitions else "static"
        writer = writer.partitionBy(*partition_columns).option("partitionOverwriteMode", mode)
    writer.parquet(path)


def single_file(df: DataFrame) -> DataFrame:
    """One output partition. Only for aggregates and top-k reports of a few rows."""
    return df.coalesce(1)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Persist for the block (spilling to disk), then release, also on failure."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()
