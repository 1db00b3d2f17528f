"""Layer runs: the only place where actions happen. Paths are URIs, local or object store.

Entities do not depend on each other, so their jobs are submitted side by side and small ones do
not leave the cluster idle. Row counts come from ``Observation`` metrics of the write itself. They
sit in the stage that writes, where Spark counts every task once however often it is retried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import layout, quality
from stratalake.operators.joins import lacking_keys
from stratalake.operators.sizes import total_bytes
from stratalake.plans import bronze, gold, refresh, runlog, silver
from stratalake.plans.runlog import EntityMetric, Run
from stratalake.schemas import GOLD_TABLES, RAW_ENTITIES
from stratalake.session import scratch_folder, sized
from stratalake.sources.files import list_files
from stratalake.sources.layers import read_gold, read_layer
from stratalake.sources.raw import (
    checked_csv, join_path, missing_columns, read_entity, require_paths)


def _now() -> datetime:
    # Naive UTC: the session zone is UTC and Spark reads naive values in the session zone.
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _percentage(records_in: int, invalid: int) -> float:
    return 100.0 if records_in <= 0 else round(max(records_in - invalid, 0) / records_in * 100, 2)


def _side_by_side(
    spark: SparkSession,
    jobs: Mapping[str, Callable[[], EntityMetric]],
    metrics: list[EntityMetric],
    width: int = 4,
) -> None:
    """Run independent Spark jobs from a few driver threads. Metrics arrive in the given order;
    those of finished jobs are kept when another one fails."""
    failures = []
    with ThreadPoolExecutor(width) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs.values()]
        for future in running:
            try:
                metrics.append(future.result())
            except Exception as failure:
                failures.append(failure)
    if failures:
        raise failures[0]


def _recorded(
    spark: SparkSession,
    job: str,
    source: str,
    target: str,
    history: str | None,
    work: Callable[[list[EntityMetric], list[str]], int | None],
) -> list[EntityMetric]:
    """Run ``work`` and append a run record, also when it fails."""
    started_at = _now()
    metrics: list[EntityMetric] = []
    paths: list[str] = []
    invalid, error = None, None
    try:
        invalid = work(metrics, paths)
    except Exception as failure:
        error = str(failure) or type(failure).__name__
        raise
    finally:
        if history is not None:
            run = Run(
                job, source, target, started_at, _now(), metrics, paths,
                invalid_records=invalid, error_message=error,
            )
            runlog.append_run(spark, history, run)
    return metrics


def raw_to_bronze(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    history: str | None = None,
    formats: Mapping[str, str] | None = None,
    multi_line: bool = False,
    started_at: datetime | None = None,
    entities: Iterable[str] = tuple(RAW_ENTITIES),
    rejects_root: str | None = None,
) -> list[EntityMetric]:
    """The raw entities, all six by default, to bronze Parquet. ``formats`` overrides the format
    per entity; ``multi_line`` says that JSON files are arrays and not lines.

    With ``rejects_root`` the CSV rows that do not fit their header or types are stored there, by
    entity with file, reason and raw text, and count as invalid; without it they enter bronze with
    NULLs.
    """
    started_at = started_at or _now()
    rejected: dict[str, DataFrame] = {}
    sources = {name: join_path(raw_root, RAW_ENTITIES[name].file_name) for name in entities}

    def read(name: str) -> DataFrame:
        fmt = (formats or {}).get(name, RAW_ENTITIES[name].fmt)
        if rejects_root is not None and fmt == "csv":
            kept, rejected[name] = checked_csv(spark, sources[name], RAW_ENTITIES[name])
            return kept
        return read_entity(spark, sources[name], name, fmt, multi_line)

    def load(name: str, df: DataFrame, paths: list[str]) -> EntityMetric:
        entity = RAW_ENTITIES[name]
        lacking = missing_columns(df, name)
        if lacking:
            raise ValueError(f"{name}: required columns missing: {', '.join(lacking)}")
        rows = Observation()
        target = join_path(bronze_root, name)
        stamped = bronze.add_lineage(df, entity.file_name, started_at)
        layout.write_entity(
            stamped.observe(rows, F.count(F.lit(1)).alias("records_in")), target
        )
        paths.append(target)
        written = rows.get["records_in"]  # nothing is dropped on the way
        if name not in rejected:
            return EntityMetric(name, written, written)
        refused = Observation()
        target = join_path(rejects_root, name)
        layout.write_entity(
            rejected[name].observe(refused, F.count(F.lit(1)).alias("rows")), target)
        paths.append(target)
        invalid = refused.get["rows"]
        return EntityMetric(name, written + invalid, written, invalid,
                            _percentage(written + invalid, invalid))

    def work(metrics: list[EntityMetric], paths: list[str]) -> None:
        require_paths(spark, sources)
        frames = {name: read(name) for name in sources}
        with sized(spark, total_bytes(frames.values())):
            _side_by_side(spark, {name: partial(load, name, df, paths)
                                  for name, df in frames.items()}, metrics)

    return _recorded(spark, "raw_to_bronze", "raw", "bronze", history, work)


def bronze_to_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    history: str | None = None,
    keep_other_dates: bool = False,
    entities: Iterable[str] = tuple(RAW_ENTITIES),
) -> list[EntityMetric]:
    """Refine, count and write each entity in a single pass over bronze."""

    def refine(name: str, df: DataFrame, paths: list[str]) -> EntityMetric:
        seen = Observation()
        keep = silver.REFINEMENTS[name].keep
        marked = silver.marked(name, df).observe(
            seen,
            F.count(F.lit(1)).alias("records_in"),
            F.count_if(F.col(silver.DEFECT)).alias("invalid"),
            F.count_if(keep() if keep else F.lit(True)).alias("records_out"),
        )
        target = join_path(silver_root, name)
        layout.write_entity(
            silver.settled(name, marked), target, silver.PARTITION_COLUMNS, keep_other_dates
        )
        paths.append(target)
        counts = seen.get
        share = _percentage(counts["records_in"], counts["invalid"])
        return EntityMetric(
            name, counts["records_in"], counts["records_out"], counts["invalid"], share)

    def work(metrics: list[EntityMetric], paths: list[str]) -> None:
        frames = read_layer(spark, bronze_root, tuple(entities))
        with sized(spark, total_bytes(frames.values())):
            _side_by_side(spark, {name: partial(refine, name, df, paths)
                                  for name, df in frames.items()}, metrics)

    return _recorded(spark, "bronze_to_silver", "bronze", "silver", history, work)


def _store_table(
    gold_root: str, name: str, df: DataFrame, records_in: int, paths: list[str],
    keep_other_partitions: bool = False,
) -> EntityMetric:
    target = join_path(gold_root, name)
    parts = GOLD_TABLES[name].partitioned_by
    rows = Observation()
    clustered = layout.cluster_for_write(df, parts)
    layout.write_entity(
        clustered.observe(rows, F.count(F.lit(1)).alias("rows")), target, parts,
        keep_other_partitions)
    paths.append(target)
    return EntityMetric(name, records_in, rows.get["rows"])


def _dimensions(entities: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_customer": gold.dim_customer(entities["customers"]),
        "dim_product": gold.dim_product(entities["products"]),
        "dim_campaign": gold.dim_campaign(entities["campaigns"]),
        "dim_date": gold.dim_date(entities["orders"], entities["web_events"]),
    }


def _members(spark: SparkSession, gold_root: str) -> list[DataFrame]:
    return list(read_layer(spark, gold_root, ("dim_customer", "dim_product", "dim_campaign")).values())


def _lacking_products(spark: SparkSession, items: DataFrame, products: DataFrame) -> DataFrame:
    """Product keys of items without a product, stored, so that Catalyst knows how few they are."""
    kept = scratch_folder(spark)
    keys = gold.with_product_key(items.select("product_id"))
    lacking_keys(keys, products, "product_key").write.parquet(kept)
    return spark.read.schema("product_key bigint").parquet(kept)


def silver_to_gold(
    spark: SparkSession, silver_root: str, gold_root: str, history: str | None = None
) -> list[EntityMetric]:
    """Dimensions first; the facts then read the written dimensions instead of rebuilding them."""

    def work(metrics: list[EntityMetric], paths: list[str]) -> int:
        entities = read_layer(spark, silver_root, RAW_ENTITIES)
        with sized(spark, total_bytes(entities.values())):
            return build(entities, metrics, paths)

    def build(
        entities: Mapping[str, DataFrame], metrics: list[EntityMetric], paths: list[str]
    ) -> int:
        counts = {row["entity"]: row for row in gold.input_counts(entities).collect()}

        def store_all(tables: dict[str, DataFrame]) -> None:
            taken = {
                name: sum(counts[entity]["records_in"] for entity in gold.INPUTS[name])
                for name in tables
            }
            _side_by_side(spark, {
                name: partial(_store_table, gold_root, name, df, taken[name], paths)
                for name, df in tables.items()}, metrics)

        store_all(_dimensions(entities))
        customers, products, campaigns = _members(spark, gold_root)
        lacking = _lacking_products(spark, entities["order_items"], products)
        store_all({
            "fct_sales": gold.fct_sales(
                entities, customers, products, campaigns, lacking=lacking),
            "fct_web_events": gold.fct_web_events(entities, customers, campaigns),
        })
        return sum(row["invalid_records"] for row in counts.values())

    return _recorded(spark, "silver_to_gold", "silver", "gold", history, work)


def refresh_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    processing_dates: Iterable[str],
    history: str | None = None,
) -> list[EntityMetric]:
    """Bring gold up to date after loads that added the silver rows of ``processing_dates``.

    The dimensions are replaced. Of the facts only the partitions of touched days are written, and
    files of all other days stay as they are. The result is that of ``silver_to_gold``. A repeated
    run, or one after a failure, writes the same partitions again. The rows read, as the run records
    them, are those that were added.
    """
    dates = list(processing_dates)

    def work(metrics: list[EntityMetric], paths: list[str]) -> None:
        entities = read_layer(spark, silver_root, RAW_ENTITIES)
        added = {name: df.where(F.col("processing_date").cast("string").isin(dates))
                 for name, df in entities.items()}
        rows = {name: df.count() for name, df in added.items()}
        added = {name: df for name, df in added.items() if rows[name]}
        if not added:
            return
        taken = {name: sum(rows[entity] for entity in gold.INPUTS[name]) for name in GOLD_TABLES}
        with sized(spark, total_bytes(entities.values())):
            _side_by_side(spark, {
                name: partial(_store_table, gold_root, name, df, taken[name], paths)
                for name, df in _dimensions(entities).items()}, metrics)
            customers, products, campaigns = _members(spark, gold_root)
            jobs = {}
            for fact, days_of in (("fct_sales", refresh.touched_sales_days),
                                  ("fct_web_events", refresh.touched_event_days)):
                reaching = {name: added[name] for name in refresh.REACH[fact] if name in added}
                if not reaching:
                    continue
                kept = scratch_folder(spark)
                days_of(entities, reaching).coalesce(1).write.parquet(kept)  # days of a calendar
                days = spark.read.parquet(kept)
                part = refresh.on_days(entities, days)
                built = (gold.fct_sales(part, customers, products, campaigns)
                         if fact == "fct_sales" else gold.fct_web_events(part, customers, campaigns))
                jobs[fact] = partial(_store_table, gold_root, fact, built, taken[fact], paths, True)
            _side_by_side(spark, jobs, metrics)

    return _recorded(spark, "refresh_gold", "silver", "gold", history, work)


def quality_checks(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    results_path: str | None = None,
    raw_root: str | None = None,
    bronze_root: str | None = None,
) -> DataFrame:
    """Evaluate every rule of the catalogue and its severity; store one JSON row per rule, plus the
    summary, where ``results_path`` is given.

    Presence of raw files and required bronze columns are looked at where their roots are given.
    """
    started_at = _now()
    entities = read_layer(spark, silver_root, RAW_ENTITIES)
    tables = read_gold(spark, gold_root)
    parts = [
        quality.evaluate(entities, (*quality.SILVER_RULES, *quality.DEDUPLICATION_RULES)),
        quality.evaluate(tables, quality.GOLD_RULES),
        quality.integrity(tables),
    ]
    if raw_root is not None:
        names = [entity.file_name for entity in RAW_ENTITIES.values()]
        parts.append(quality.raw_file_presence(list_files(spark, raw_root), names))
    if bronze_root is not None:
        parts.append(quality.required_columns(
            spark, read_layer(spark, bronze_root, RAW_ENTITIES)))
    results = quality.with_severity(reduce(DataFrame.unionByName, parts))
    kept = results_path or scratch_folder(spark)
    checks = join_path(kept, "checks")
    with sized(spark, total_bytes([*entities.values(), *tables.values()])):
        results.coalesce(1).write.mode("overwrite").json(checks)
    stored = spark.read.schema(results.schema).json(checks)
    if results_path is not None:
        seconds = (_now() - started_at).total_seconds()
        quality.summary(stored, seconds).write.mode("overwrite").json(
            join_path(results_path, "summary"))
    return stored
