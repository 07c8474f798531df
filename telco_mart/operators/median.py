"""Exact medians without one task per group.

Spark's exact ``percentile``/``median`` aggregate keeps a value -> count map
per group and merges it in ONE task, so a group holding a third of a 100 TB
fact (one event type) would put every distinct amount of that third in one
task's memory. Here one aggregate counts each distinct (group, value), combined
map-side, so a hot value is one row per task; running totals over the order of
(group, value) give each its ranks (a group of very many values is spread over
many ranges), and the rows that hold the wanted ranks are the result.

There is no threshold on rows: all sizes and spreads (infinities included) take
the same path. The result equals ``percentile(v, 0.5)``: ``0.5*a + 0.5*b`` of the
middle ranks ``(n-1) div 2`` and ``n div 2``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telco_mart.operators.lookup import join_lookup
from telco_mart.operators.prefix import running_totals
from telco_mart.session import checkpoint_dir


def group_medians(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """Exact median of ``value`` per ``group`` (or of the whole column when
    ``group`` is None) as ``(group, median)`` rows; NULL and NaN values are
    ignored, a NULL group is left out, a group without values has no row."""
    n = F.col("n")
    found = _values_at(df, value, group, {1: F.floor((n - 1) / 2), 2: F.floor(n / 2)})
    low, high = F.max(F.when(F.col("which") == 1, F.col("v"))), F.max(F.when(F.col("which") == 2, F.col("v")))
    both = found.groupBy("_g").agg(low.alias("v1"), high.alias("v2"))
    med = F.when(F.col("v1") == F.col("v2"), F.col("v1")).otherwise(F.lit(0.5) * F.col("v1") + F.lit(0.5) * F.col("v2"))
    return both.select(F.col("_g").alias(group or "_all"), med.alias("median"))


def group_quantiles(df: DataFrame, value: str, q: float, group: str | None = None) -> DataFrame:
    """(group, quantile): the value of rank ceil(q * n) - 1 of each group."""
    found = _values_at(df, value, group, {1: F.greatest(F.ceil(F.col("n") * F.lit(q)) - 1, F.lit(0))})
    return found.select(F.col("_g").alias(group or "_all"), F.col("v").alias("quantile"))


def _values_at(df: DataFrame, value: str, group: str | None, ranks: dict[int, Column]) -> DataFrame:
    """(_g, which, v): the values at 0-based ranks, stated over the count n."""
    checkpoint_dir(df.sparkSession)
    gcol = F.col(group) if group else F.lit(0)
    base = (df.select(gcol.alias("_g"), F.col(value).cast("double").alias("_v"))
            .filter(F.col("_v").isNotNull() & ~F.isnan("_v") & F.col("_g").isNotNull()))
    counts = base.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("c")).checkpoint()
    placed = running_totals(counts, F.struct("_g", "_v"), {"c": "upto"})
    wanted = F.array(*(F.struct(F.lit(k).alias("which"), r.cast("long").alias("rank")) for k, r in ranks.items()))
    groups = placed.groupBy("_g").agg(F.sum("c").alias("n"), F.min(F.col("upto") - F.col("c")).alias("start"))
    groups = groups.select("_g", "start", wanted.alias("wanted")).checkpoint()
    first, after = F.col("upto") - F.col("c") - F.col("start"), F.col("upto") - F.col("start")
    here = F.filter("wanted", lambda w: (w["rank"] >= first) & (w["rank"] < after))
    held = join_lookup(placed, groups, ["_g"]).select("_g", F.col("_v").alias("v"), F.explode(here).alias("w"))
    return held.select("_g", "w.which", "v").checkpoint()
