"""Dense surrogate keys without collisions, and the map that later loads extend.

Ids are sorted by range partitions. The place of an id is its place in the partition plus the ids of
the partitions before it, so numbers come from one sort and a prefix sum over the partitions, never
from a single task. Known ids keep their number; new ones follow the highest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import scratch_folder
from stratalake.sources.raw import open_or_none

KEY = "dense_key"
#: ``monotonically_increasing_id`` holds the partition above this many bits for the row.
_ROW_BITS = 33


def new_keys(ids: DataFrame, id_col: str, known: DataFrame | None = None) -> DataFrame:
    """(id, dense_key) of the distinct non-NULL ids that ``known`` (id, dense_key) lacks.

    Numbers begin at 1, or after the highest known one, without gaps, in the order of the ids.
    """
    spark = ids.sparkSession
    fresh = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    highest = 0
    if known is not None:
        fresh = fresh.join(known.select(id_col), id_col, "left_anti")
        highest = known.agg(F.max(KEY)).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = fresh.repartitionByRange(width, id_col).sortWithinPartitions(id_col).withColumn(
        "_at", F.monotonically_increasing_id())
    path = scratch_folder(spark)
    placed.write.parquet(path)  # numbers of a stored sort cannot change any more
    part = F.shiftright("_at", _ROW_BITS)
    stored = spark.read.schema(placed.schema).parquet(path).withColumn("_part", part)
    # One row for each partition.
    sizes = stored.groupBy("_part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    return stored.join(F.broadcast(offsets), "_part").select(
        id_col, (F.col("_before") + place + (highest + 1)).alias(KEY))


def extended_map(ids: DataFrame, id_col: str, path: str) -> DataFrame:
    """The key map below ``path`` after numbers for new ids were added to it.

    One writer at a time. Repeating a load adds nothing.
    """
    spark = ids.sparkSession
    known = open_or_none(lambda: spark.read.parquet(path))
    added = new_keys(ids, id_col, known)
    if known is not None and added.isEmpty():
        return known
    added.write.mode("append").parquet(path)
    return spark.read.parquet(path)
