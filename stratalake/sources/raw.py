"""Raw readers. Columns are matched by name and typed explicitly; no type is inferred."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.schemas import RAW_ENTITIES, RawEntity
from stratalake.session import scratch_folder, settings
from stratalake.sources.records import ESCAPED_LINES, LINES, array_as_lines, split_records


def read_csv(spark: SparkSession, path: str, entity: RawEntity) -> DataFrame:
    """Header CSV; empty fields are NULL, values that do not parse are NULL.

    Read as text by header name, so column order is free and no inference pass runs over the
    data. Columns the catalogue does not know are kept as text. All files of one path share one
    header: Spark reads every file in the order of the first, so a file whose header differs fails
    the job instead of being read by position.
    """
    header = spark.read.option("header", True).csv(path).schema
    text = spark.read.schema(header).option("header", True).option("enforceSchema", False).csv(path)
    return text.select(*[_typed(F.col(name), name, entity) for name in text.columns])


def _typed(value: Column, name: str, entity: RawEntity) -> Column:
    kind = entity.columns.get(name, "string")
    whole = value.try_cast("double") if kind == "int" else value
    return whole.try_cast(kind).alias(name)


def checked_csv(
    spark: SparkSession, path: str, entity: RawEntity, split_bytes: int | None = None,
    escape: str = '"',
) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the header and the types, and the others as (file, reason, raw_text).

    Quoted line breaks stay within their row, and large files are still read by many tasks. Every
    row that is not blank is in one of the two frames. Quotes inside quotes are doubled, or follow a
    backslash where that is the ``escape``, as in files that Spark wrote. All files have to share a
    header.
    """
    names = spark.read.option("header", True).csv(path).columns
    with settings(spark, {} if split_bytes is None else {
            "spark.sql.files.maxPartitionBytes": str(split_bytes),
            "spark.sql.files.openCostInBytes": "0"}):
        kind = LINES if escape == '"' else ESCAPED_LINES
        found = split_records(spark, path, kind).withColumn(
            "text", F.regexp_replace(F.col("text").cast("string"), r"\r?\n$", ""))
    if found.where("first").select("text").distinct().count() > 1:
        raise ValueError(f"the files of {path} have different headers")
    quoted = {name: f"`{name.replace('`', '``')}`" for name in names}
    schema = ", ".join(f"{name} string" for name in [*quoted.values(), "_unfit"])
    rows = found.where(~F.col("first") & (F.trim("text") != "")).select("file", "text", F.from_csv(
        "text", schema, {"columnNameOfCorruptRecord": "_unfit", "escape": escape}).alias("row"))
    value = {name: F.col("row")[name] for name in names}
    lost = F.array_compact(F.array(*[
        F.when(value[name].isNotNull() & _typed(value[name], name, entity).isNull(),
               F.lit(f"{name} is no {entity.columns.get(name)}")) for name in names]))
    reason = F.when(F.col("row._unfit").isNotNull(), F.lit("number of fields")).when(
        F.size(lost) > 0, F.array_join(lost, ", "))
    # Stored: two frames are read from it, and a filter on the reason would parse rows anew.
    folder = scratch_folder(spark)
    rows.withColumn("reason", reason).withColumn(
        "text", F.when(F.col("reason").isNotNull(), F.col("text"))).write.parquet(folder)
    judged = spark.read.parquet(folder)
    listing = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("path"))
    files = listing.select(F.xxhash64("path").alias("file"), F.col("path"))
    kept = judged.where("reason is null").select(
        *[_typed(value[name], name, entity) for name in names])
    rejected = judged.where("reason is not null").join(files, "file").select(
        F.col("path").alias("file"), "reason", F.col("text").alias("raw_text"))
    return kept, rejected


def read_json(
    spark: SparkSession, path: str, entity: RawEntity, multi_line: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """JSON lines, or array files on request (``multi_line``), which are first cut into lines.

    The columns are those that the data holds: one pass looks for their names, declared ones are
    then cast to their type and the others kept, so a check of required columns sees what is there.
    """
    lines = array_as_lines(spark, path, split_bytes) if multi_line else path
    text = spark.read.option("primitivesAsString", True).json(lines)
    return text.select(*[
        F.col(name).try_cast(entity.columns[name]).alias(name)
        if name in entity.columns and text.schema[name].dataType.typeName() == "string"
        else F.col(f"`{name}`")
        for name in text.columns
    ])


def read_entity(
    spark: SparkSession, path: str, name: str, fmt: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Read one raw entity from CSV, JSON or Parquet."""
    entity = RAW_ENTITIES[name]
    fmt = fmt or entity.fmt
    if fmt == "csv":
        return read_csv(spark, path, entity)
    if fmt == "json":
        return read_json(spark, path, entity, multi_line)
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported raw format: {fmt}")


def missing_columns(df: DataFrame, name: str) -> list[str]:
    """Declared columns that the source does not have; a schema check, no data is read."""
    return [column for column in RAW_ENTITIES[name].columns if column not in df.columns]


def open_or_none(reader: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None where its path does not exist. Any URI Spark can list works."""
    try:
        return reader()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    return open_or_none(lambda: spark.read.format("binaryFile").load(path)) is not None


def fail_on_missing(missing: Iterable[str]) -> None:
    names = ", ".join(missing)
    if names:
        raise FileNotFoundError(f"missing input datasets: {names}")


def require_paths(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail before any work starts, naming every missing dataset (name -> path)."""
    fail_on_missing(
        f"{name} ({path})" for name, path in paths.items() if not path_exists(spark, path)
    )


def join_path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])
