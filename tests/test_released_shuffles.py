"""A job of several writes holds no shuffle files of the writes that have ended."""

from __future__ import annotations

from checks.lake import Lake
from checks.raw_entities import RAW_SQL
from stratalake.plans import runner
from stratalake.session import RELEASED, settings, sized

SF_DIR = "/root/testdata/sf0.001"


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(k).getName() for k in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


def test_a_layer_run_leaves_no_shuffle_files(spark, tmp_path):
    lake = Lake(spark, SF_DIR)
    for name in RAW_SQL:
        lake.silver[name].write.parquet(str(tmp_path / "silver" / name))
    before = shuffle_files(spark)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        runner.silver_to_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"))
    assert shuffle_files(spark) <= before
    sales = spark.read.parquet(str(tmp_path / "gold" / "fct_sales"))
    assert sales.count() == lake.tables["fct_sales"].count() > 0


def test_a_frame_may_be_run_again_in_and_after_a_sized_block(spark):
    former = {key: spark.conf.get(key) for key in RELEASED}
    with sized(spark, 0):
        counts = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
        first = sorted(counts.collect())
        assert sorted(counts.collect()) == first and len(first) == 7
    assert sorted(counts.collect()) == first
    assert {key: spark.conf.get(key) for key in RELEASED} == former
