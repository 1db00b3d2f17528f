"""Readers for the Parquet layers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from stratalake.schemas import GOLD_TABLES
from stratalake.sources.raw import fail_on_missing, join_path, open_or_none


def read_layer(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """One DataFrame per dataset below ``root``; partition columns come back from the paths.

    Each path is listed once, and a missing dataset is reported together with all others.
    """
    paths = {name: join_path(root, name) for name in names}
    frames = {
        name: open_or_none(lambda path=path: spark.read.parquet(path))
        for name, path in paths.items()
    }
    fail_on_missing(f"{name} ({paths[name]})" for name, df in frames.items() if df is None)
    return frames


def read_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The six star-schema tables in their declared column order."""
    tables = read_layer(spark, root, GOLD_TABLES)
    return {name: df.select(*GOLD_TABLES[name].columns) for name, df in tables.items()}
