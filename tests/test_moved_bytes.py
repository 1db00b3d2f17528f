"""What a job shuffles or writes more than once, with tables too large for a broadcast."""

from __future__ import annotations

from pathlib import Path
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from checks import upkeep
from checks.lake import Lake
from checks.queries import QUERIES
from stratalake.operators import joins, layout
from stratalake.plans import gold, runner
from stratalake.session import settings

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def facts(spark):
    key = F.when(F.col("id") % 1000 != 0, F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(50_000).select(key.alias("k"), "id")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lacking_keys_leave_the_rows_of_keep_known(spark, facts):
    members = spark.range(4990).select(F.concat(F.lit("k"), "id").alias("k"))
    lacking = joins.lacking_keys(facts, members, "k")
    assert sorted(r.k for r in lacking.collect()) == [f"k{n}" for n in range(4990, 5000)]
    ours, theirs = joins.drop_lacking(facts, lacking, "k"), joins.keep_known(facts, members, "k")
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_unused_columns_are_not_shuffled(spark, tmp_path, facts):
    facts.withColumns({"used": F.col("id") + 1, "spare": F.col("id") + 2}).write.parquet(
        str(tmp_path / "t"))
    members = spark.range(4990).select(F.concat(F.lit("k"), "id").alias("k"))
    read = spark.read.parquet(str(tmp_path / "t"))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for met in (joins.keep_known(read, members, "k"), joins.lookup_join(read, members, ["k"])):
            met = met.select("used")
            assert "SortMergeJoin" in plan(met) and "spare" not in plan(met)
        assert "sales_key" not in plan(QUERIES["j12_fct_sales"](Lake(spark, SF_DIR)))


def test_few_lacking_products_are_broadcast(spark):
    silver = Lake(spark, SF_DIR).silver
    products, items = silver["products"], silver["order_items"]
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "10k"}):
        keyed = gold.dim_product(products)
        lacking = runner._lacking_products(spark, items, keyed)
        assert not lacking.isEmpty()
        sales = gold.fct_sales(silver, silver["customers"], keyed, silver["campaigns"], lacking=lacking)
        assert "BroadcastHashJoin [product_key" in plan(sales)
        before = gold.fct_sales(silver, silver["customers"], keyed, silver["campaigns"])
        assert sales.exceptAll(before).isEmpty() and before.exceptAll(sales).isEmpty()


def test_entities_are_written_with_zstd(spark, tmp_path):
    layout.write_entity(spark.range(10), str(tmp_path / "t"))
    assert all(f.name.endswith(".zstd.parquet") for f in Path(tmp_path, "t").glob("part-*"))


def test_key_maps_are_built_side_by_side(spark, monkeypatch):
    met, build = Barrier(len(upkeep.KEYED), timeout=60), upkeep.dense_keys.extended_map

    def together(ids, key, path):
        met.wait()  # breaks unless all maps are being built
        return build(ids, key, path)

    monkeypatch.setattr(upkeep.dense_keys, "extended_map", together)
    found = {r.entity: r for r in upkeep.dense(Lake(spark, SF_DIR)).collect()}
    assert set(found) == set(upkeep.KEYED)
    assert all(r.ids == r.dense_keys == r.highest and r.lowest == 1 and not r.changed
               for r in found.values())
