"""Incremental runs, bad numbers, duplicate keys, plan history, exact curves."""

import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from telco_mart.operators import dimensions as D
from telco_mart.operators import facts as FA
from telco_mart.operators import ml as ML
from telco_mart.operators import snapshots as SN
from telco_mart.operators.prefix import running_totals
from telco_mart.operators.runs import RunStore
from telco_mart.plans.etl import run_etl
from telco_mart.plans.warehouse import DRIVER_CONFIG, Warehouse
from telco_mart.session import scratch_path
from telco_mart.sources import driver_tables as DT

from conftest import SMALL


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_second_run_merges_and_a_repeat_changes_nothing(spark):
    root = scratch_path(spark, f"t_inc_{uuid.uuid4().hex[:8]}")
    first = Warehouse(spark, SMALL)
    early = first.raw("usage").filter("substring(usage_id, -1, 1) <> '1'")
    w1, _, _ = run_etl(spark, SMALL, root, marts=False, feeds={"usage": early})
    n1 = w1.fact_usage.count()
    delta = {"subscribers": DT.raw_subscribers(first.tables, delta=True)}
    cfg = replace(DRIVER_CONFIG, as_of="2002-01-01")
    w2, _, log = run_etl(spark, SMALL, root, cfg, marts=False, feeds=delta)
    stages = {r.table_name: r for r in log.collect()}
    assert w2.fact_usage.count() == first.fact_usage.count() > n1
    assert stages["fact_usage"].rows_inserted == w2.fact_usage.count() - n1
    assert w2.dim_subscriber.filter("version = 2").count() > 0 and stages["dim_subscriber"].rows_updated > 0
    assert stages["dim_subscriber"].rows_rejected == first.subscriber_rejects.count()
    before = {n: rows(getattr(w2, n)) for n in ("dim_subscriber", "dim_plan", "dim_tower", "fact_usage", "fact_incident")}
    months = rows(RunStore(spark, root).read("fact_subscriber_monthly"))
    w3, _, _ = run_etl(spark, SMALL, root, cfg, marts=False, feeds=delta)
    assert {n: rows(getattr(w3, n)) for n in before} == before
    assert rows(RunStore(spark, root).read("fact_subscriber_monthly")) == months
    assert spark.read.parquet(f"{root}/etl_log").select("run_id").distinct().count() == 3


def test_a_failing_mart_ends_the_run(spark, monkeypatch):
    from telco_mart.plans import etl

    monkeypatch.setitem(etl.MARTS, "kpi_arpu", lambda w: w.fact_usage.select(F.raise_error(F.lit("no mart")).cast("int").alias("x"), "annee", F.lit(1).alias("mois")))
    root = scratch_path(spark, f"t_fail_{uuid.uuid4().hex[:8]}")
    with pytest.raises(Exception, match="no mart"):
        run_etl(spark, SMALL, root)
    log = {r.table_name: r.status for r in spark.read.parquet(f"{root}/etl_log").collect()}
    assert log["kpi_arpu"] == "FAILED" and log["kpi_churn_mensuel"] == "SUCCESS" and "kpi_retention_par_offre" not in log


def test_numbers_out_of_range_are_nulled_and_quarantined(spark):
    w = Warehouse(spark, SMALL)
    assert w.fact_usage.filter("amount_fcfa is null").count() > 0
    reasons = {r.rejection_reason for r in w.quarantine().select("rejection_reason").distinct().collect()}
    assert "Valeur numérique hors limites" in reasons
    assert w.plans.filter("monthly_fee is null").count() == w.raw("plans").filter("monthly_fee = '1e12'").count() > 0


def test_first_load_keeps_one_row_per_key(spark):
    subs = spark.createDataFrame([("S1", "a"), ("S1", "b"), ("S2", "c")], "subscriber_id string, segment string")
    dim = D.scd2_initial(subs, "subscriber_id", "2026-01-01", "sk")
    assert sorted((r.subscriber_id, r.segment) for r in dim.collect()) == [("S1", "b"), ("S2", "c")]
    towers = spark.createDataFrame([("T1", "x"), ("T1", "y")], "tower_id string, city string")
    assert [r.city for r in D.build_dim_tower(towers).collect()] == ["y"]


def _dims(spark):
    sub = "subscriber_id string, plan_id string, date_debut date, date_fin date, is_current int, version int"
    s = spark.sql("""SELECT * FROM VALUES ('S1', 'A', DATE '2020-01-01', DATE '2021-01-01', 0, 1),
        ('S1', 'B', DATE '2021-01-01', NULL, 1, 2) AS t(subscriber_id, plan_id, date_debut, date_fin, is_current, version)""")
    p = spark.sql("""SELECT * FROM VALUES ('A', 900L, DATE '2020-01-01', DATE '2020-06-01', 0, 1), ('A', 100L, DATE '2020-06-01', NULL, 1, 2),
        ('B', 5L, DATE '2020-01-01', NULL, 1, 1) AS t(plan_id, plan_sk, date_debut, date_fin, is_current, version)""")
    return s, p


def test_plan_as_of_the_event(spark):
    s, p = _dims(spark)
    u = spark.sql("""SELECT * FROM VALUES ('u0', 'S1', DATE '2019-01-01'), ('u1', 'S1', DATE '2020-03-01'), ('u2', 'S1', DATE '2020-07-01'),
        ('u3', 'S1', DATE '2021-01-01'), ('u4', 'S9', DATE '2021-01-01') AS t(usage_id, subscriber_id, event_date)""")
    got = {r.usage_id: r.plan_sk for r in FA.plan_point_in_time(u, s, p).collect()}
    assert got == {"u0": None, "u1": 900, "u2": 100, "u3": 5, "u4": None}


def test_the_latest_plan_version_is_not_the_largest_key(spark):
    _, p = _dims(spark)
    usage = spark.sql("""SELECT *, CAST(1 AS DECIMAL(12,4)) AS data_mb, 1 AS duration_sec, CAST(1 AS DECIMAL(12,2)) AS amount_fcfa, 'Data' AS event_type, 'x' AS status
        FROM VALUES (1L, 20200301, 900L), (1L, 20200701, 100L) AS t(subscriber_sk, date_sk, plan_sk)""")
    subs = spark.sql("SELECT 1L AS subscriber_sk, 'S1' AS subscriber_id, 'T1' AS tower_id, 1 AS churn, CAST(NULL AS DATE) AS churn_date, 1 AS is_current")
    tower = spark.sql("SELECT 'T1' AS tower_id, 7L AS tower_sk")
    inc = spark.sql("SELECT 7L AS tower_sk, 20200301 AS date_sk LIMIT 0")
    snap = SN.monthly_snapshots(subs, tower, usage, inc, ["2020-07"], dim_plan=p).collect()
    assert [(r.plan_sk, r.churn_status) for r in snap] == [(100, 0)]


def test_usage_load_joins_each_dimension_once(spark):
    """With broadcasts off, the usage load has two fact-wide joins, on the
    subscriber and on the tower, and none on event type or place."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = Warehouse(spark, SMALL).materialize(scratch_path(spark, f"t_join_{uuid.uuid4().hex[:8]}"))
        del w.__dict__["_fact_usage"], w.__dict__["_usage_resolved"]
        plan = w._fact_usage[0]._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    wide = [j for j in joins if "subscriber_id" in j or "tower_id" in j]
    assert len(wide) == 2 and not any("event_type#" in j and "strategy=broadcast" not in j.lower() and "<=>" not in j for j in joins)


def test_single_month_split_is_stratified(spark):
    df = spark.range(1000).select(F.concat(F.lit("S"), "id").alias("subscriber_id"), F.lit("2020-01").alias("snapshot_month"),
                                  (F.col("id") % 10 == 0).cast("int").alias("churn_status"))
    n = {(r.churn_status, r.split): r["count"] for r in ML.temporal_split(df).groupBy("churn_status", "split").count().collect()}
    assert n == {(0, "train"): 720, (0, "test"): 180, (1, "train"): 80, (1, "test"): 20}


def test_auc_and_roc_are_exact(spark):
    scored = [(i % 3 == 0, ((i * 7919) % 997) / 997 if i % 5 else 0.5) for i in range(600)]
    df = spark.createDataFrame([(int(y), p, float(p >= 0.5)) for y, p in scored], "churn_status int, p_churn double, prediction double").repartition(7)
    pos, neg = [p for y, p in scored if y], [p for y, p in scored if not y]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    assert ML.metrics(df).first().auc == pytest.approx(want, abs=1e-12)
    points = {r.threshold: (r.fpr, r.tpr) for r in ML.roc_points(df).collect()}
    assert points[None] == (0, 0) and len(points) == len({p for _, p in scored}) + 1
    for t in (0.5, max(pos)):
        assert points[t] == (sum(b >= t for b in neg) / len(neg), sum(a >= t for a in pos) / len(pos))
    assert ML.auc(df.filter("churn_status = 0")).first().auc == 0


def test_running_totals_over_many_ranges(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("v")).repartition(9)
    got = {r.id: r.total for r in running_totals(df, F.col("id").desc(), {"v": "total"}).collect()}
    assert got == {i: sum(k % 7 for k in range(i, 500)) for i in range(500)}
