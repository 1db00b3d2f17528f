"""Publication of gold tables, query results and the mart view to the SQL catalogue."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.sizes import total_bytes
from stratalake.plans import marts
from stratalake.plans.frames import Star
from stratalake.schemas import GOLD_TABLES
from stratalake.session import sized
from stratalake.sources.layers import read_gold
from stratalake.sources.raw import join_path, require_paths

GOLD_DB = "gold"
ANALYTICS_DB = "analytics"


def _switch(spark: SparkSession, target: str, location: str, parts: tuple[str, ...] = ()) -> None:
    """Point table ``target`` to the Parquet data at ``location``, which is complete by now.

    A table of the same shape only gets the new location, so readers never find it missing.
    """
    schema = spark.read.parquet(location).schema
    quoted = location.replace("'", "\\'")
    former = spark.table(target).schema if spark.catalog.tableExists(target) else None
    if not parts and former is not None and former.simpleString() == schema.simpleString():
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{quoted}'")
        spark.catalog.refreshTable(target)
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"CREATE TABLE {target} ({columns}) USING parquet {by} LOCATION '{quoted}'")
    if parts:
        spark.catalog.recoverPartitions(target)


def publish_gold(spark: SparkSession, gold_root: str, database: str = GOLD_DB) -> list[str]:
    """Register each gold table over its Parquet directory; no data is copied."""
    require_paths(spark, {name: join_path(gold_root, name) for name in GOLD_TABLES})
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, table in GOLD_TABLES.items():
        _switch(spark, f"{database}.{name}", join_path(gold_root, name), table.partitioned_by)
    return [f"{database}.{name}" for name in GOLD_TABLES]


def gold_frames(spark: SparkSession, database: str = GOLD_DB) -> Star:
    return Star({name: spark.table(f"{database}.{name}") for name in GOLD_TABLES})


def materialise(
    spark: SparkSession,
    results: Mapping[str, DataFrame | str],
    root: str,
    database: str = ANALYTICS_DB,
) -> list[str]:
    """Store each query, given as a DataFrame or as SQL text, as a table below ``root``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    published = []
    for name, query in results.items():
        df = spark.sql(query.strip().rstrip(";")) if isinstance(query, str) else query
        # Every run writes to a folder of its own: a failing query leaves the old table as it was.
        location = join_path(root, name, f"run-{uuid4().hex}")
        df.write.parquet(location)
        _switch(spark, f"{database}.{name}", location)
        published.append(f"{database}.{name}")
    return published


def sql_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """File stem -> query text of every ``*.sql`` file directly below ``folder``."""
    listing = (
        spark.read.option("wholetext", True)
        .option("pathGlobFilter", "*.sql")
        .text(folder)
        .select(
            F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.sql$", 1).alias("name"),
            "value",
        )
        .orderBy("name")
    )
    return {row["name"]: row["value"] for row in listing.toLocalIterator()}


def publish_mart_view(spark: SparkSession, database: str = GOLD_DB) -> str:
    """``dm_sales_overview`` as a view over the published tables, always current."""
    view = f"{database}.dm_sales_overview"
    query = marts.SALES_OVERVIEW_SQL.format(**{name: f"{database}.{name}" for name in GOLD_TABLES})
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
    return view


def manifest(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(schema_name, table_name, row_count, source) per published table, counted in one job."""
    rows = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name.split(".")[0]).alias("schema_name"),
            F.lit(name.split(".")[1]).alias("table_name"),
            "row_count",
            F.lit(source).alias("source"),
        )
        for name, (df, source) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def publish(spark: SparkSession, gold_root: str, serving_root: str) -> DataFrame:
    """Gold tables, the mart view and all analytics tables; returns the manifest."""
    gold = publish_gold(spark, gold_root)
    publish_mart_view(spark)
    star = gold_frames(spark)
    queries = {name: build(star) for name, build in marts.ANALYTICS.items()}
    # Sizes come from the files: a catalogue table without statistics counts as endless.
    with sized(spark, total_bytes(read_gold(spark, gold_root).values())):
        analytics = materialise(spark, queries, serving_root)
    sources = {f"{GOLD_DB}.{name}": join_path(gold_root, name) for name in GOLD_TABLES}
    sources |= {f"{ANALYTICS_DB}.{name}": join_path(serving_root, name) for name in queries}
    return manifest({name: (spark.table(name), sources[name]) for name in [*gold, *analytics]})
