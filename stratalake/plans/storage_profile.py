"""Storage profile of the layers from a (layer, path, length) file listing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.schemas import LAYERS

GIB = 1024**3
TIB = 1024**4


@dataclass(frozen=True)
class ProfileParameters:
    """Fixed default prices, ratios and thresholds of the estimate."""

    storage_cost_per_gb_month: float = 0.023
    scan_cost_per_tb: float = 5.0
    columnar_scan_ratio: float = 0.35
    partition_pruning_ratio: float = 0.25
    small_file_bytes: int = 16 * 1024 * 1024
    small_file_ratio: float = 0.5
    min_files: int = 5


DEFAULTS = ProfileParameters()


def small_files_flag(
    files: Column, small_files: Column, average_bytes: Column, p: ProfileParameters = DEFAULTS
) -> Column:
    """Enough files, and either many small ones or a small average."""
    ratio = small_files / F.nullif(files, F.lit(0))
    crowded = (ratio >= p.small_file_ratio) | (average_bytes < p.small_file_bytes)
    return (files >= p.min_files) & F.coalesce(crowded, F.lit(False))


def layer_profile(
    listing: DataFrame,
    layers: tuple[str, ...] = LAYERS,
    p: ProfileParameters = DEFAULTS,
    roots: dict[str, str] | None = None,
) -> DataFrame:
    """Files, bytes, average, small files and the flag per layer; empty layers give zeros.

    ``roots``, the folders that were listed, adds the ``path`` of each layer.
    """
    names = F.array(*[F.lit(layer) for layer in layers])
    spark = listing.sparkSession
    all_layers = spark.range(1).select(F.explode(names).alias("layer"))
    counted = listing.groupBy("layer").agg(
        F.count("*").alias("file_count"),
        F.sum("length").alias("total_size_bytes"),
        F.count_if(F.col("length") < p.small_file_bytes).alias("small_file_count"),
    )
    measured = all_layers.join(counted, "layer", "left").na.fill(0)
    if roots is not None:
        paths = F.create_map(*[F.lit(part) for pair in roots.items() for part in pair])
        measured = measured.withColumn("path", paths[F.col("layer")])
    files, total, small = (
        F.col("file_count"), F.col("total_size_bytes"), F.col("small_file_count"),
    )
    divisor = F.nullif(files, F.lit(0))
    average = F.coalesce(F.floor(total / divisor), F.lit(0))
    return measured.withColumns(
        {
            "average_file_size_bytes": average,
            "small_file_ratio": F.coalesce(F.round(small / divisor, 4), F.lit(0.0)),
        }
    ).withColumn(
        "has_small_files_problem",
        small_files_flag(files, small, F.col("average_file_size_bytes"), p),
    )


def with_estimates(profile: DataFrame, p: ProfileParameters = DEFAULTS) -> DataFrame:
    """Storage and scan estimates; the optimised scan reads fewer columns and partitions."""
    total = F.col("total_size_bytes")
    optimised = (total * F.lit(p.columnar_scan_ratio) * F.lit(p.partition_pruning_ratio)).cast(
        "bigint"
    )

    def scan_cost(size: Column) -> Column:
        return F.round(size / F.lit(float(TIB)) * p.scan_cost_per_tb, 6)

    sized = profile.withColumns(
        {
            "storage_cost": F.round(
                total / F.lit(float(GIB)) * p.storage_cost_per_gb_month, 6
            ),
            "scan_bytes": total,
            "scan_cost": scan_cost(total),
            "optimized_scan_bytes": optimised,
            "optimized_scan_cost": scan_cost(optimised),
        }
    )
    return sized.withColumns(
        {
            "savings_bytes": F.greatest(F.col("scan_bytes") - F.col("optimized_scan_bytes"),
                                        F.lit(0)),
            "savings_cost": F.round(
                F.greatest(F.col("scan_cost") - F.col("optimized_scan_cost"), F.lit(0.0)), 6
            ),
        }
    )


def profile_totals(estimates: DataFrame) -> DataFrame:
    """One row over all layers, with the flagged layers as a sorted list."""
    costs = ("storage_cost", "scan_cost", "optimized_scan_cost", "savings_cost")
    return estimates.agg(
        F.count("*").alias("total_layers"),
        F.sum("file_count").alias("total_files"),
        F.sum("total_size_bytes").alias("total_storage_bytes"),
        *[F.round(F.sum(name), 6).alias(f"total_{name}") for name in costs],
        F.array_sort(
            F.collect_list(F.when(F.col("has_small_files_problem"), F.col("layer")))
        ).alias("layers_with_small_files"),
    )
