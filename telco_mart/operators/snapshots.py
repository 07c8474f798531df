"""Monthly subscriber snapshots and the inactivity risk report.

All requested months are computed in ONE job instead of one scan per month:

1. the fact is aggregated to (subscriber, month) with every monthly measure and
   the last activity day, and apart from that to the distinct plans a subscriber
   used (map-side partial agg); plan versions are looked up for the latter;
2. the (subscriber, month) grid comes from exploding the (bounded) month list
   on each current subscriber - no join to generate it;
3. "last activity on or before the month" is a running max over each
   subscriber's months (a window partitioned by subscriber: one small
   partition per subscriber, never a hot group);
4. incidents are pre-aggregated per (tower, month) and joined by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telco_mart import config as C
from telco_mart.functions.keys import date_from_key
from telco_mart.operators.dimensions import current
from telco_mart.operators.lookup import join_lookup
from telco_mart.schemas import FACT_SUBSCRIBER_MONTHLY, conform


def _label(month: str):
    """2024-01 of 202401."""
    return F.concat_ws("-", F.floor(F.col(month) / 100).cast("string"), F.lpad((F.col(month) % 100).cast("string"), 2, "0"))


def _monthly_usage(fact_usage: DataFrame, sms_types) -> DataFrame:
    """(subscriber, month) measures and last day."""
    f = fact_usage.withColumn("_month", F.floor(F.col("date_sk") / 100).cast("int"))
    sums = f.groupBy("subscriber_sk", "_month").agg(
        F.sum("data_mb").alias("data_used_mb"),
        F.sum("duration_sec").alias("voice_used_sec"),
        F.count_if(F.col("event_type").isin(list(sms_types))).alias("sms_used"),
        F.sum("amount_fcfa").alias("revenue_fcfa"),
        F.count_if(F.col("status") == C.STATUS_FAILED).alias("failed_calls"),
        F.max("date_sk").alias("_last_sk"))
    return sums.withColumns({"snapshot_month": _label("_month"), "_last_day": date_from_key("_last_sk")}).drop("_month", "_last_sk")


def _latest_plan(fact_usage: DataFrame, dim_plan: DataFrame | None, by: list[str]) -> DataFrame:
    """``by`` and ``_plan_max``, (start date, version, key) of the latest plan
    version used; without ``dim_plan`` only the key. Versions are looked up for
    the distinct plans used, which are far fewer than the events."""
    used = fact_usage.withColumn("_month", F.floor(F.col("date_sk") / 100).cast("int")).select(*by, "plan_sk").distinct()
    if dim_plan is not None:
        versions = dim_plan.select("plan_sk", F.col("date_debut").alias("_from"), F.col("version").alias("_version"))
        used = join_lookup(used, versions, ["plan_sk"])
    else:
        used = used.withColumns({"_from": F.lit(None).cast("date"), "_version": F.lit(None).cast("int")})
    plan = F.when(F.col("plan_sk").isNotNull(), F.struct("_from", "_version", "plan_sk"))
    return used.groupBy(*by).agg(F.max(plan).alias("_plan_max"))


def monthly_snapshots(dim_subscriber: DataFrame, dim_tower: DataFrame, fact_usage: DataFrame,
                      fact_incident: DataFrame, months: list[str],
                      sms_types=tuple(C.SMS_TYPES), plan_upto_month: bool = False,
                      by: str = "subscriber_sk", dim_plan: DataFrame | None = None, conformed: bool = True) -> DataFrame:
    """One row per (current subscriber, month in ``months``).

    ``conformed=False`` leaves the sums in the types that they were added in, for
    a contract that reports what the table's columns cannot hold.

    plan_sk is the latest plan version (by start date, then version, looked up
    in ``dim_plan``) over *all* the subscriber's usage, as the original's
    largest increasing key; ``plan_upto_month=True`` restricts it to usage up to
    the month. Without ``dim_plan`` it is the largest key.
    ``by="subscriber_id"`` counts the usage of earlier versions of the
    subscriber too (the original keys by version, so history stays behind).
    days_since_active = last day of the month - last activity day on or before
    it, or 999 without activity; churn_status = churned in or before the month.
    """
    months = sorted(months)
    last_month = months[-1]
    if by == "subscriber_id":
        # usage of every version counts for the subscriber: re-key the fact to
        # the current version of the same natural key (one equi-join)
        ver = dim_subscriber.select("subscriber_sk", "subscriber_id")
        cur = current(dim_subscriber).select("subscriber_id", F.col("subscriber_sk").alias("_cur_sk"))
        remap = ver.join(cur, "subscriber_id").select("subscriber_sk", "_cur_sk")
        fact_usage = (fact_usage.join(remap, "subscriber_sk")
                      .withColumn("subscriber_sk", F.col("_cur_sk")).drop("_cur_sk"))
    elif by != "subscriber_sk":
        raise ValueError(by)
    mon = _monthly_usage(fact_usage, sms_types).filter(F.col("snapshot_month") <= last_month)
    subs = current(dim_subscriber).select("subscriber_sk", "tower_id", "churn", "churn_date")
    grid = subs.select("subscriber_sk", "tower_id", "churn", "churn_date",
                       F.explode(F.array(*[F.lit(m) for m in months])).alias("snapshot_month"))

    # running last-activity over each subscriber's months
    act = mon.select("subscriber_sk", "snapshot_month", "_last_day", F.lit(0).alias("_is_grid"))
    marks = grid.select("subscriber_sk", "snapshot_month", F.lit(None).cast("date").alias("_last_day"), F.lit(1).alias("_is_grid"))
    w = (Window.partitionBy("subscriber_sk").orderBy("snapshot_month", "_is_grid")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = (act.unionByName(marks)
           .withColumn("_last_upto", F.max("_last_day").over(w))
           .filter(F.col("_is_grid") == 1)
           .select("subscriber_sk", "snapshot_month", "_last_upto"))
    if plan_upto_month:  # the same over the months of the plans used
        used = _latest_plan(fact_usage, dim_plan, ["subscriber_sk", "_month"])
        used = used.select("subscriber_sk", _label("_month").alias("snapshot_month"), "_plan_max", F.lit(0).alias("_is_grid"))
        empty = grid.select("subscriber_sk", "snapshot_month", F.lit(None).cast(used.schema["_plan_max"].dataType).alias("_plan_max"), F.lit(1).alias("_is_grid"))
        plans = (used.unionByName(empty).withColumn("_plan", F.max("_plan_max").over(w))
                 .filter(F.col("_is_grid") == 1).select("subscriber_sk", "snapshot_month", "_plan"))
        plan_keys = ["subscriber_sk", "snapshot_month"]
    else:
        plans = _latest_plan(fact_usage, dim_plan, ["subscriber_sk"]).withColumnRenamed("_plan_max", "_plan")
        plan_keys = ["subscriber_sk"]

    tw = dim_tower.select("tower_id", "tower_sk")
    inc = (fact_incident.withColumn("snapshot_month", F.date_format(date_from_key("date_sk"), "yyyy-MM"))
           .filter(F.col("snapshot_month").isin(months))
           .groupBy("tower_sk", "snapshot_month").agg(F.count(F.lit(1)).alias("network_incidents")))

    j = (grid.join(mon.drop("_last_day"), ["subscriber_sk", "snapshot_month"], "left")
         .join(run, ["subscriber_sk", "snapshot_month"], "left")
         .join(plans, plan_keys, "left")
         .join(tw, "tower_id", "left")
         .join(inc, ["tower_sk", "snapshot_month"], "left"))
    month_end = F.last_day(F.to_date(F.concat(F.col("snapshot_month"), F.lit("-01"))))
    out = j.select(
        "subscriber_sk", "snapshot_month",
        F.col("_plan.plan_sk").alias("plan_sk"),
        F.coalesce("data_used_mb", F.lit(0)).alias("data_used_mb"),
        F.coalesce("voice_used_sec", F.lit(0)).alias("voice_used_sec"),
        F.coalesce("sms_used", F.lit(0)).alias("sms_used"),
        F.coalesce("revenue_fcfa", F.lit(0)).alias("revenue_fcfa"),
        F.coalesce("network_incidents", F.lit(0)).alias("network_incidents"),
        F.coalesce("failed_calls", F.lit(0)).alias("failed_calls"),
        F.coalesce(F.datediff(month_end, F.col("_last_upto")), F.lit(C.NO_ACTIVITY_DAYS)).alias("days_since_active"),
        F.coalesce((F.col("churn") == 1) & (F.date_format("churn_date", "yyyy-MM") <= F.col("snapshot_month")), F.lit(False))
        .cast("int").alias("churn_status"),
    )
    return conform(out, FACT_SUBSCRIBER_MONTHLY) if conformed else out


def churn_risk(dim_subscriber: DataFrame, fact_usage: DataFrame, as_of: str, min_days: int = 60
               ) -> DataFrame:
    """Non-churned current subscribers whose last usage day is at least
    ``min_days`` before ``as_of``; most inactive first."""
    s = current(dim_subscriber).filter(F.col("churn") == 0).select(
        "subscriber_sk", "subscriber_id", "first_name", "last_name", "city", "country")
    last = fact_usage.groupBy("subscriber_sk").agg(F.max("date_sk").alias("_last_sk"))
    j = s.join(last, "subscriber_sk").withColumn("derniere_activite", date_from_key("_last_sk"))
    out = (j.groupBy("subscriber_id", "first_name", "last_name", "city", "country")
           .agg(F.max("derniere_activite").alias("derniere_activite"))
           .withColumn("jours_inactivite", F.datediff(F.lit(as_of).cast("date"), F.col("derniere_activite")))
           .filter(F.col("jours_inactivite") >= min_days))
    return out.orderBy(F.col("jours_inactivite").desc(), "subscriber_id")
