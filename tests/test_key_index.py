"""The id index: which rows are new, and what the plan reads and shuffles."""

import uuid

from pyspark.sql import functions as F

from telco_mart.operators.key_index import KeyIndex
from telco_mart.session import scratch_path


def test_new_rows_and_runs(spark):
    index = KeyIndex(spark, scratch_path(spark, f"t_index_{uuid.uuid4().hex[:8]}"), buckets=5)
    batch = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "usage_id string, v int")
    assert index.new_rows(batch, "usage_id").count() == 4
    index.add(batch.filter("v < 3"), "usage_id", "one")
    index.add(batch.filter("v >= 3"), "usage_id", "two")
    assert [r.usage_id for r in index.new_rows(batch, "usage_id").collect()] == [None]
    assert sorted(str(r.usage_id) for r in index.new_rows(batch, "usage_id", ["one"]).collect()) == ["None", "c"]
    again = KeyIndex(spark, index.path, buckets=5)
    assert sorted(r.id for r in again.ids().collect()) == ["a", "b", "c"]


def test_only_the_batch_is_shuffled(spark):
    index = KeyIndex(spark, scratch_path(spark, f"t_index_{uuid.uuid4().hex[:8]}"), buckets=6)
    rows = spark.range(5000).select(F.concat(F.lit("U"), "id").alias("usage_id"), F.col("id").alias("v"))
    index.add(rows.filter("v % 3 > 0"), "usage_id", "one")
    new = index.new_rows(rows, "usage_id")
    assert new.count() == 1667 and new.filter("v % 3 > 0").count() == 0
    plan = new._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index(f"Scan parquet spark_catalog.default.{index.table}") - 400:]
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in below
