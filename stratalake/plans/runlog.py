"""Run metrics: one row per run, an append-only history, and summaries over it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import columns as c
from stratalake.schemas import RUN_STATUSES
from stratalake.sources.files import artifact_sizes, list_files

ENTITY_FIELDS = (
    "entity string, records_in bigint, records_out bigint, invalid_records bigint, "
    "quality_percentage double"
)


def _struct(fields: str) -> str:
    return ", ".join(part.replace(" ", ": ", 1) for part in fields.split(", "))


RUN_SCHEMA = (
    "job_name string, started_at timestamp, finished_at timestamp, duration_seconds double, "
    "source_layer string, target_layer string, records_in bigint, records_out bigint, "
    "invalid_records bigint, valid_data_percentage double, "
    "generated_files array<struct<path: string, size_bytes: bigint, file_count: bigint>>, "
    "approx_file_size_bytes bigint, status string, "
    f"entity_metrics array<struct<{_struct(ENTITY_FIELDS)}>>, "
    "error_message string"
)


@dataclass(frozen=True)
class EntityMetric:
    entity: str
    records_in: int
    records_out: int
    invalid_records: int = 0
    quality_percentage: float = 100.0


@dataclass(frozen=True)
class Run:
    """What a runner knows when a job ends."""

    job_name: str
    source_layer: str
    target_layer: str
    started_at: datetime
    finished_at: datetime
    entities: Sequence[EntityMetric] = ()
    generated_paths: Sequence[str] = ()
    invalid_records: int | None = None
    status: str | None = None
    error_message: str | None = None
    records_in: int | None = None
    records_out: int | None = None


def status_of(invalid: Column, explicit: Column, error: Column) -> Column:
    """Explicit status, else failed on an error text, else warning on invalid rows."""
    return (
        F.when(explicit.isNotNull(), explicit)
        .when(F.coalesce(F.length(error) > 0, F.lit(False)), F.lit("failed"))
        .when(invalid > 0, F.lit("warning"))
        .otherwise(F.lit("success"))
    )


def run_row(spark: SparkSession, run: Run) -> DataFrame:
    """The run as a one-row DataFrame, with artifact sizes listed from storage."""
    if run.status is not None and run.status not in RUN_STATUSES:
        raise ValueError(f"invalid status {run.status!r}, use one of {RUN_STATUSES}")

    def total(name: str) -> int:
        given = getattr(run, name)
        return sum(getattr(e, name) for e in run.entities) if given is None else given

    base = spark.createDataFrame(
        [(
            run.job_name, run.started_at, run.finished_at,
            round((run.finished_at - run.started_at).total_seconds(), 2),
            run.source_layer, run.target_layer,
            total("records_in"), total("records_out"), total("invalid_records"),
            [tuple(asdict(metric).values()) for metric in run.entities],
            run.status, run.error_message,
        )],
        "job_name string, started_at timestamp, finished_at timestamp, duration_seconds double, "
        "source_layer string, target_layer string, records_in bigint, records_out bigint, "
        f"invalid_records bigint, entity_metrics array<struct<{_struct(ENTITY_FIELDS)}>>, "
        "explicit_status string, error_message string",
    )
    files = artifact_sizes(spark, run.generated_paths).agg(
        F.array_sort(
            F.collect_list(F.struct(F.col("artifact").alias("path"), "size_bytes", "file_count"))
        ).alias("generated_files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("approx_file_size_bytes"),
    )
    return base.select(
        "job_name", "started_at", "finished_at", "duration_seconds",
        "source_layer", "target_layer", "records_in", "records_out", "invalid_records",
        c.percentage_valid(F.col("records_in"), F.col("invalid_records")).alias(
            "valid_data_percentage"
        ),
        files.select("generated_files").scalar().alias("generated_files"),
        files.select("approx_file_size_bytes").scalar().alias("approx_file_size_bytes"),
        status_of(
            F.col("invalid_records"), F.col("explicit_status"), F.col("error_message")
        ).alias("status"),
        "entity_metrics",
        "error_message",
    )


def append_run(spark: SparkSession, history_path: str, run: Run) -> None:
    """Add one run in a folder of its own; jobs that end at the same time share no output folder,
    so none removes what another one has not committed yet."""
    run_row(spark, run).coalesce(1).write.json(f"{history_path.rstrip('/')}/run-{uuid4().hex}")


def _folds(history_path: str) -> str:
    return f"{history_path.rstrip('/')}_folded"


def _latest_fold(spark: SparkSession, history_path: str) -> DataFrame | None:
    """The runs of the newest fold, each with the name of the file it came from."""
    names = list_files(spark, _folds(history_path)).select(
        F.max(F.element_at(F.split("path", "/"), -2)).alias("name")).first()["name"]
    if names is None:
        return None
    schema = f"{RUN_SCHEMA}, origin string"
    return spark.read.schema(schema).json(f"{_folds(history_path)}/{names}")


def _open_runs(spark: SparkSession, history_path: str, fold: DataFrame | None) -> DataFrame | None:
    """The runs whose files the fold does not hold; no other file is opened."""
    files = list_files(spark, history_path).withColumn(
        "origin", F.element_at(F.split("path", "/"), -1))
    if fold is not None:
        files = files.join(fold.select("origin"), "origin", "left_anti")
    paths = [row["path"] for row in files.select("path").collect()]  # runs since the last fold
    if not paths:
        return None
    return spark.read.schema(RUN_SCHEMA).json(paths).withColumn(
        "origin", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def _all_runs(spark: SparkSession, history_path: str) -> DataFrame:
    fold = _latest_fold(spark, history_path)
    tail = _open_runs(spark, history_path, fold)
    empty = spark.createDataFrame([], f"{RUN_SCHEMA}, origin string")
    return reduce(DataFrame.unionByName, [df for df in (fold, tail) if df is not None] or [empty])


def fold_history(spark: SparkSession, history_path: str) -> None:
    """Put all runs that are there now into one file beside the history.

    A fold is complete by itself and names the files it holds, and a reader takes the newest fold and
    the files it does not name. Files are never removed here, so runs added meanwhile and folds made
    at the same time lose nothing and count nothing twice. Folded files may be deleted at leisure.
    """
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    _all_runs(spark, history_path).coalesce(1).write.json(
        f"{_folds(history_path)}/{stamp}-{uuid4().hex}")


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    """All runs, newest first: the newest fold and the runs since."""
    return _all_runs(spark, history_path).drop("origin").orderBy(F.desc("started_at"), "job_name")


def history_summary(runs: DataFrame) -> DataFrame:
    """Runs by status and the job of the latest run."""
    counts = [
        F.count_if(F.col("status") == status).alias(f"{status}_executions")
        for status in RUN_STATUSES
    ]
    return runs.agg(
        F.count("*").alias("total_executions"),
        *counts,
        F.max_by("job_name", F.struct("started_at", "job_name")).alias("last_job_name"),
    )


def overall_status(runs: DataFrame, checks: DataFrame) -> DataFrame:
    """not_started / failed / warning / success over all runs and quality checks."""
    run_counts = runs.agg(
        F.count("*").alias("executions"),
        F.count_if(F.col("status") == "failed").alias("failed_executions"),
        F.count_if(F.col("status") == "warning").alias("warning_executions"),
    )
    check_counts = checks.agg(
        F.count("*").alias("checks"), F.count_if(~F.col("passed")).alias("failed_checks")
    )
    joined = run_counts.select(
        "*",
        check_counts.select("checks").scalar().alias("checks"),
        check_counts.select("failed_checks").scalar().alias("failed_checks"),
    )
    status = (
        F.when((F.col("executions") == 0) & (F.col("checks") == 0), "not_started")
        .when(F.col("failed_executions") > 0, "failed")
        .when((F.col("failed_checks") > 0) | (F.col("warning_executions") > 0), "warning")
        .otherwise("success")
    )
    return joined.withColumn("overall_status", status)


def execution_window(runs: DataFrame) -> DataFrame:
    return runs.agg(F.min("started_at").alias("started_at"), F.max("finished_at").alias(
        "finished_at"))


def latest_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    return (
        runs.orderBy(F.desc("started_at"), "job_name")
        .limit(n)
        .select(
            "job_name", "status", "duration_seconds", "records_in", "records_out",
            "invalid_records",
        )
    )


def failed_checks(checks: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` failed quality checks, by layer, entity and rule."""
    return (
        checks.filter(~F.col("passed"))
        .orderBy("layer", "entity", "rule_name")
        .limit(n)
        .select("layer", "entity", "rule_name", "failed_records")
    )
