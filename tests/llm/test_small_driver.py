"""What grows with the corpus is not built in the driver's memory, however small its files look."""

from __future__ import annotations

from pyspark.sql import functions as F
from stratalake.llm import simhash
from stratalake.llm.common import stored
from stratalake.session import settings


def static_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_anchors_and_prints_are_not_broadcast(spark):
    near = [(k, f"{'one two three four five six seven eight nine ten ' * 20}end") for k in range(9)]
    docs = spark.createDataFrame(near, "doc_id long, text string")
    prints = stored(spark.range(2000).select(F.xxhash64("id").alias("print")))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": str(10 * 2**20)}):
        assert "BroadcastHashJoin" not in static_plan(simhash.links(prints))
        found = simhash.near_duplicates(docs)
        joins = [x for x in static_plan(found).splitlines() if "Join [print" in x]
        assert joins and "SortMergeJoin" in joins[0]
        assert [r.component_id for r in found.collect()] == [0] * 9
