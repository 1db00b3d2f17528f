from __future__ import annotations

import datetime as dt

import pytest

from stratalake.operators import quality
from stratalake.plans import runlog, storage_profile
from stratalake.plans.runlog import EntityMetric, Run
from stratalake.sources.files import artifact_sizes, list_files, list_layers
from stratalake.sources.raw import path_exists, require_paths

START = dt.datetime(2024, 4, 1, 12, 0, 0)


@pytest.fixture
def layers(tmp_path):
    roots = {name: tmp_path / name for name in ("raw", "bronze", "silver", "gold")}
    for name in ("raw", "bronze", "silver"):
        (roots[name] / "sub").mkdir(parents=True)
    for i in range(5):
        (roots["bronze"] / "sub" / f"part-{i}.parquet").write_bytes(b"x" * 1024)
    (roots["raw"] / "a.csv").write_bytes(b"x" * 3_000_000)
    (roots["silver"] / ".gitkeep").write_bytes(b"")
    return {name: str(path) for name, path in roots.items()}


def test_layer_profile(spark, layers):
    p = storage_profile.ProfileParameters(small_file_bytes=1024 * 1024)
    profile = storage_profile.layer_profile(list_layers(spark, layers), p=p)
    found = {r.layer: r for r in storage_profile.with_estimates(profile, p).collect()}
    assert set(found) == {"raw", "bronze", "silver", "gold"}
    bronze = found["bronze"]
    assert (bronze.file_count, bronze.total_size_bytes, bronze.average_file_size_bytes) == (
        5, 5120, 1024)
    assert bronze.has_small_files_problem and bronze.small_file_ratio == 1.0
    assert bronze.optimized_scan_bytes == int(5120 * 0.35 * 0.25)
    assert bronze.savings_bytes == 5120 - 448
    raw = found["raw"]
    assert not raw.has_small_files_problem and raw.savings_bytes > 0
    assert raw.storage_cost == round(3_000_000 / 1024**3 * 0.023, 6)
    for empty in ("silver", "gold"):
        row = found[empty]
        assert (row.file_count, row.total_size_bytes, row.small_file_ratio) == (0, 0, 0.0)
        assert row.has_small_files_problem is False
    totals = storage_profile.profile_totals(storage_profile.with_estimates(profile, p)).first()
    assert (totals.total_layers, totals.total_files, totals.total_storage_bytes) == (
        4, 6, 3_005_120)
    assert totals.layers_with_small_files == ["bronze"]


@pytest.mark.parametrize(
    ("files", "small", "average", "flag"),
    [(4, 4, 1, False), (5, 5, 1, True), (6, 3, 99, True), (6, 2, 99, False), (6, 0, 9, True),
     (0, 0, 0, False)],
)
def test_small_files_flag(rows, files, small, average, flag):
    p = storage_profile.ProfileParameters(small_file_bytes=10)
    df = rows("f bigint, s bigint, a bigint", (files, small, average))
    expr = storage_profile.small_files_flag(df.f, df.s, df.a, p)
    assert df.select(expr.alias("x")).first().x is flag


def test_file_listing(spark, layers, tmp_path):
    assert list_files(spark, layers["bronze"]).count() == 5
    assert list_files(spark, layers["gold"]).count() == 0
    sizes = artifact_sizes(spark, [layers["bronze"], layers["bronze"], layers["gold"],
                                   layers["raw"], layers["silver"]]).collect()
    assert [(r.artifact, r.file_count, r.size_bytes) for r in sizes] == [
        (layers["bronze"], 5, 5120), (layers["raw"], 1, 3_000_000), (layers["silver"], 0, 0)]
    assert artifact_sizes(spark, []).count() == 0
    assert path_exists(spark, layers["bronze"]) and not path_exists(spark, layers["gold"])
    with pytest.raises(FileNotFoundError) as failure:
        require_paths(
            spark, {"a": layers["bronze"], "b": layers["gold"], "c": str(tmp_path / "zip")})
    assert layers["gold"] in str(failure.value) and "zip" in str(failure.value)
    assert layers["bronze"] not in str(failure.value)


def run(job="job", start=START, invalid=0, **changes) -> Run:
    return Run(job, "raw", "bronze", start, start + dt.timedelta(seconds=12),
               [EntityMetric("customers", 10, 10, invalid)], **changes)


def test_run_row(spark, layers):
    row = runlog.run_row(spark, run(generated_paths=[layers["bronze"]])).first()
    assert (row.status, row.valid_data_percentage, row.duration_seconds) == ("success", 100.0, 12.0)
    assert [tuple(f) for f in row.generated_files] == [(layers["bronze"], 5120, 5)]
    assert row.approx_file_size_bytes == 5120 and row.error_message is None
    assert runlog.run_row(spark, run(invalid=1)).first().status == "warning"
    assert runlog.run_row(spark, run(invalid=1, error_message="x")).first().status == "failed"
    assert runlog.run_row(spark, run(error_message="x", status="success")).first().status == (
        "success")
    assert runlog.run_row(spark, run(error_message="")).first().status == "success"
    with pytest.raises(ValueError, match="invalid status"):
        runlog.run_row(spark, run(status="great"))


def test_history(spark, tmp_path):
    path = str(tmp_path / "history")
    runlog.append_run(spark, path, run("first"))
    runlog.append_run(spark, path, run("second", START + dt.timedelta(hours=1), invalid=1))
    history = runlog.read_history(spark, path)
    assert [r.job_name for r in history.collect()] == ["second", "first"]
    assert runlog.history_summary(history).first().asDict() == {
        "total_executions": 2, "success_executions": 1, "warning_executions": 1,
        "failed_executions": 0, "last_job_name": "second"}
    window = runlog.execution_window(history).first()
    assert window.started_at == START
    assert window.finished_at == START + dt.timedelta(hours=1, seconds=12)
    assert [r.job_name for r in runlog.latest_runs(history, 1).collect()] == ["second"]


@pytest.mark.parametrize(
    ("statuses", "passed", "expected"),
    [([], [], "not_started"), ([], [True], "success"), (["success"], [False], "warning"),
     (["warning"], [True], "warning"), (["failed", "success"], [True], "failed"),
     (["success"], [], "success")],
)
def test_overall_status(rows, statuses, passed, expected):
    runs = rows("status string", *[(s,) for s in statuses])
    checks = rows("passed boolean", *[(p,) for p in passed])
    assert runlog.overall_status(runs, checks).first().overall_status == expected


def test_failed_checks_lists_only_failures(rows):
    customers = rows("customer_id string, email string, is_email_valid boolean",
                     (None, "a@b.co", True))
    results = quality.evaluate({"customers": customers},
                               [quality.SILVER_RULES[0], quality.SILVER_RULES[-1]])
    assert [tuple(r) for r in runlog.failed_checks(results).collect()] == [
        ("silver", "customers", "customer_id_not_null", 1)]
