"""Size checks that decide whether a join side may be broadcast."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import size_in_bytes

# In-memory bytes of a hinted side: small next to an executor heap.
BROADCAST_LIMIT = 50 * 1024 * 1024
ROW_OVERHEAD = 32


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimised plan; None where it cannot be read."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # Spark Connect has no JVM handle: unknown, hence "not small"
        return None


def total_bytes(frames: Iterable[DataFrame]) -> int:
    """Estimated input of a job that reads all of ``frames``; fails where a size is unknown.

    A size counted as nothing would leave a large job with the session's default width. On Spark
    Connect pass the bytes of a file listing to ``session.sized`` instead.
    """
    sizes = [estimated_bytes(df) for df in frames]
    if None in sizes:
        raise ValueError("input size unknown: give session.sized the bytes of the file listing")
    return sum(sizes)


def measured_bytes(df: DataFrame) -> int | None:
    """Exact in-memory width of all rows, from one aggregate over ``df``.

    None with an array, map, struct or variant column: such a value has no bound that is cheap to
    measure, so it is never called small.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    if any(isinstance(field.dataType, nested) for field in df.schema.fields):
        return None
    width = F.lit(ROW_OVERHEAD)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + F.lit(16)
        else:
            width = width + F.lit(16)
    return int(df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0])


def auto_limit(spark: SparkSession) -> int:
    """The session's own broadcast threshold in bytes; -1 when automatic broadcasts are off."""
    return size_in_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


def looks_small(df: DataFrame, limit: int | None = None) -> bool:
    """Whether Catalyst would broadcast ``df`` on its own. It only gates an exact measurement."""
    size = estimated_bytes(df)
    return size is not None and size <= (auto_limit(df.sparkSession) if limit is None else limit)


def broadcast_if_bounded(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only once the size is proven; otherwise leave the choice to Catalyst.

    The estimate comes from compressed file sizes, so it only gates the exact measurement: a
    side that looks big is never scanned for this, one that looks small is measured.
    """
    if looks_small(df, limit):
        size = measured_bytes(df)
        if size is not None and size <= limit:
            return F.broadcast(df)
    return df
