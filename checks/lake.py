"""Lazy frames of every layer over one test-data directory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.raw_entities import RAW_SQL, TABLES
from stratalake.plans import bronze, gold, silver
from stratalake.plans.frames import Frames, Star
from stratalake.schemas import RAW_ENTITIES
from stratalake.session import scratch_folder
from stratalake.sources.raw import join_path

RUN_AT = datetime(2024, 4, 1, 6, 30, 15)


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def scratch(self, name: str) -> str:
        return join_path(scratch_folder(self.spark), name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, entity: str) -> DataFrame:
        used = {name: self.table(name) for name in TABLES if "{" + name + "}" in RAW_SQL[entity]}
        return self.spark.sql(RAW_SQL[entity], **used)

    def deliver(self, entity: str, root: str | None = None, files: int | None = None) -> str:
        """The raw entity as its source would write it, below ``root`` or a fresh folder."""
        root, source, raw = root or self.scratch("raw"), RAW_ENTITIES[entity], self.raw(entity)
        if files is not None:
            raw = raw.repartition(files)
        if entity == "products":
            raw = raw.withColumn("created_at", F.lit("2023-01-01"))
        path = join_path(root, source.file_name)
        if source.fmt == "json":
            text = F.col("event_timestamp").cast("string")  # as text, with all its digits
            raw.withColumn("event_timestamp", text).write.json(path)
        else:
            raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
                "ignoreTrailingWhiteSpace", False).csv(path)
        return root

    def bronze(self, entity: str) -> DataFrame:
        return bronze.add_lineage(self.raw(entity), f"{entity}.src", RUN_AT)

    @cached_property
    def silver(self) -> Frames:
        def build(name: str) -> Callable[[], DataFrame]:
            return lambda: silver.silver(name, self.raw(name))

        return Frames({name: build(name) for name in RAW_SQL})

    @cached_property
    def tables(self) -> Frames:
        return Frames(gold.star_builders(self.silver))

    @cached_property
    def star(self) -> Star:
        return Star(self.tables)
