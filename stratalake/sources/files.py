"""File listings as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.raw import open_or_none


def _no_files(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(F.lit(None).cast("string").alias("path"), F.col("id").alias(
        "length"))


def _listing(spark: SparkSession, path: str) -> DataFrame | None:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = open_or_none(lambda: reader.load(path))
    return None if files is None else files.select("path", "length")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of every data file below ``path``; a missing path gives no rows.

    The content column is never selected, so files are listed but not opened. Spark leaves out
    marker files whose names start with a dot or an underscore.
    """
    files = _listing(spark, path)
    return _no_files(spark) if files is None else files


def list_layers(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """(layer, path, length) over several layer roots."""
    parts = [
        list_files(spark, root).select(F.lit(layer).alias("layer"), "path", "length")
        for layer, root in roots.items()
    ]
    return reduce(DataFrame.union, parts)


def artifact_sizes(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(artifact, file_count, size_bytes) per distinct existing path, in path order."""
    found = {path: _listing(spark, path) for path in sorted(set(paths))}
    found = {path: files for path, files in found.items() if files is not None}
    # One empty entry per path, so a folder without files still shows with zeros.
    names = F.array(*[F.lit(path) for path in found]).cast("array<string>")
    folders = spark.range(1).select(
        F.explode(names).alias("artifact"),
        F.lit(None).cast("string").alias("path"),
        F.lit(0).cast("bigint").alias("length"),
    )
    parts = [files.select(F.lit(path).alias("artifact"), "*") for path, files in found.items()]
    return (
        reduce(DataFrame.union, parts, folders)
        .groupBy("artifact")
        .agg(F.count("path").alias("file_count"), F.sum("length").alias("size_bytes"))
        .orderBy("artifact")
    )
