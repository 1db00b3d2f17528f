"""Session construction and the two runtime profiles used by the benchmark queries."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from tempfile import mkdtemp
from uuid import uuid4

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# Everything here is a Spark SQL conf that can be changed on a running session.
TUNED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Catalyst compares compressed file sizes with this, so it stays far below what fits in memory;
    # AQE uses the same limit on real shuffle sizes at run time.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * MIB),
    # A selective dimension that is too large to broadcast sends a Bloom filter to the scan of the
    # fact, so rows without a match are dropped before the shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(64 * MIB),
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(256 * MIB),
}
NAIVE = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "200",
}
PROFILES = {"tuned": TUNED, "naive": NAIVE}
# Shuffle files otherwise stay until the driver's garbage collection meets their plan: a job of several
# writes then holds those of all of them on disk. A frame that is run again makes its files again.
RELEASED = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.connect.shuffleDependency.fileCleanup.enabled": "true",
}


def shuffle_partitions(input_bytes: int, target_bytes: int = 256 * MIB, minimum: int = 4) -> int:
    """Shuffle width for a job reading ``input_bytes``; AQE merges what turns out too small."""
    return max(minimum, -(-input_bytes // target_bytes))


def object_store_conf(
    endpoint: str, access_key: str, secret_key: str, path_style: bool = True
) -> dict[str, str]:
    """Hadoop settings for an S3-compatible store, ready for ``build_session(extra=...)``."""
    # Hadoop's own setting names.
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https://")).lower(),
    }


def build_session(
    app_name: str = "stratalake",
    master: str | None = None,
    remote: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC timestamps, ANSI casts and the tuned profile.

    ``master`` and ``remote`` stay unset on a cluster, where spark-submit supplies them.
    """
    builder = SparkSession.builder.appName(app_name)
    if remote is not None:
        builder = builder.remote(remote)
    elif master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        **TUNED,
        **(extra or {}),
    }
    if remote is not None:
        settings.pop("spark.serializer")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share, below ``spark.checkpoint.dir``.

    Only a local master may do without that setting and use the machine's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/stratalake-{uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return mkdtemp(prefix="run-", dir="/tmp")


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[SparkSession]:
    former = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in former.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def profile(
    spark: SparkSession, name: str, shuffle_width: int | None = None
) -> AbstractContextManager[SparkSession]:
    """Apply the ``tuned`` or ``naive`` profile and restore the former values on exit."""
    wanted = dict(PROFILES[name])
    if shuffle_width is not None:
        wanted["spark.sql.shuffle.partitions"] = str(max(4, shuffle_width))
    return settings(spark, wanted)


def sized(
    spark: SparkSession, input_bytes: int, target_bytes: int = 256 * MIB
) -> AbstractContextManager[SparkSession]:
    """Widen shuffles for a job over ``input_bytes`` to ``target_bytes`` a partition; never narrows.

    AQE can merge shuffle partitions but not add any, so the starting width has to fit the input.
    There is no upper limit: a caller who wants fewer, larger partitions raises ``target_bytes``.
    The setting belongs to the session, so jobs of different size that run at the same time should
    each have a session of their own (``spark.newSession()``).

    Shuffle files of each write or action in the block go when it ends, see ``RELEASED``.
    """
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return settings(spark, RELEASED | {"spark.sql.shuffle.partitions": str(
        max(width, shuffle_partitions(input_bytes, target_bytes)))})


_UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30,
          "gb": 2**30, "t": 2**40, "tb": 2**40}


def size_in_bytes(value: str) -> int:
    """A Spark size setting such as ``10MB``, ``10485760b`` or ``-1``."""
    text = value.strip().lower()
    digits = text.rstrip("bkmgt")
    return int(digits) * _UNITS[text[len(digits):]]
