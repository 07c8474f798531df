"""Running totals over a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telco_mart.session import checkpoint_dir


def running_totals(df: DataFrame, order: Column, totals: dict[str, str]) -> DataFrame:
    """``df`` with inclusive running sums (column -> name of its sum) in the
    given order, which must not have ties.

    Rows are dealt by ranges of the order and frozen by a checkpoint; each range
    sums itself, and the sums of the ranges before it (one row per range) are
    added.
    """
    checkpoint_dir(df.sparkSession)
    parts = df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()).checkpoint()
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in totals])  # one row per range
    before = sums.select("_range", *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in totals])
    out = parts.withColumns({f"_in_{c}": F.sum(c).over(inside) for c in totals}).join(F.broadcast(before), "_range")
    return out.select(*df.columns, *[(F.col(f"_in_{c}") + F.col(f"_before_{c}")).alias(n) for c, n in totals.items()])
