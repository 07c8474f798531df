"""Materialisation, streaming replay and erasure protection."""

import uuid

import pytest
from pyspark.sql import functions as F

from telco_mart.operators import dimensions as D
from telco_mart.operators.export import materialize, read_current
from telco_mart.operators.scd import scd2_initial, scd2_merge
from telco_mart.plans.warehouse import Warehouse
from telco_mart.session import scratch_path
from telco_mart.streaming.ingest import ingest_usage

from conftest import SMALL


def test_materialize_versions_and_pointer(spark):
    root = scratch_path(spark, f"t_mat_{uuid.uuid4().hex[:8]}")
    p1 = materialize(spark.range(3).toDF("x"), root)
    p2 = materialize(spark.range(5).toDF("x"), root)
    assert p1 != p2
    assert read_current(spark, root).count() == 5
    assert spark.read.parquet(p1).count() == 3   # previous version untouched


def test_stream_replay_adds_nothing(spark):
    w = Warehouse(spark, SMALL)
    root = scratch_path(spark, f"t_stream_{uuid.uuid4().hex[:8]}")
    src, target = f"{root}/landing", f"{root}/fact"
    raw = w.raw("usage")
    # two landing files arriving one after the other
    raw.filter(F.col("usage_id").substr(2, 1) < "5").write.parquet(f"{src}/part1")
    ingest_usage(spark, f"{src}/part1", target, f"{root}/ck", w)
    n1 = spark.read.parquet(target).count()
    ingest_usage(spark, f"{src}/part1", target, f"{root}/ck_replay", w)
    assert spark.read.parquet(target).count() == n1
    ids = spark.read.parquet(target).select("usage_id")
    assert ids.distinct().count() == ids.count()


def test_erased_subscriber_stays_erased(spark):
    schema = "subscriber_id string, first_name string, last_name string, nom_complet string, " \
             "city string, segment string, plan_id string, churn int, churn_date date, " \
             "monthly_revenue double, phone_number string, email string"
    v1 = scd2_initial(spark.createDataFrame(
        [("S1", "ANONYMISE", "ANONYMISE", "ANONYMISE ANONYMISE", "Accra", "P", "P1", 0, None, 1.0, None, None)],
        schema), "subscriber_id", "2026-01-01", "sk")
    # the source still carries the identity and a tracked change
    inc = spark.createDataFrame(
        [("S1", "Ama", "Owusu", "Ama Owusu", "Kumasi", "P", "P1", 0, None, 1.0, "+233", "a@b.co")], schema)
    erased = spark.createDataFrame([("S1",)], "subscriber_id string")
    out = scd2_merge(v1, inc, "subscriber_id", D.SUBSCRIBER_TRACKED, D.SUBSCRIBER_TYPE1, "2026-01-02", "sk",
                     protected=erased, protected_cols={"first_name": "ANONYMISE", "last_name": "ANONYMISE",
                                                       "phone_number": None, "email": None})
    rows = out.collect()
    assert len(rows) == 2
    assert all(r.first_name == "ANONYMISE" and r.phone_number is None and r.email is None for r in rows)


def test_run_etl_logs_every_table(spark):
    from telco_mart.plans.etl import run_etl
    root = scratch_path(spark, f"t_etl_{uuid.uuid4().hex[:8]}")
    w, kpis, log = run_etl(spark, SMALL, root)
    rows = {r.table_name: r for r in log.collect()}
    assert all(r.status == "SUCCESS" for r in rows.values())
    assert len(kpis) == 7
    assert rows["fact_usage"].rows_inserted == w.fact_usage.count()
    assert rows["fact_usage"].rows_extracted == rows["stg_usage"].rows_inserted
    assert rows["fact_usage"].rows_rejected == rows["stg_usage"].rows_inserted - w.fact_usage.count()
    assert rows["kpi_arpu"].rows_inserted == kpis["kpi_arpu"].count()
    # the run log is persisted next to the warehouse
    assert spark.read.parquet(f"{root}/etl_log").count() == len(rows)
    # facts are partitioned by year on disk
    assert "annee" in w.fact_usage.columns


def test_run_log_success_and_failure(spark):
    from telco_mart.plans.etl import RunLog
    log = RunLog(spark)
    root = scratch_path(spark, f"t_log_{uuid.uuid4().hex[:8]}")
    src = spark.range(10).toDF("x")
    assert log.write("stg_x", "LOAD", src, lambda d: d.write.parquet(f"{root}/stg_x"))
    kept = spark.read.parquet(f"{root}/stg_x").filter(F.col("x") < 7)
    log.write("dim_x", "LOAD", kept, lambda d: d.write.parquet(f"{root}/dim_x"), extracted_from="stg_x", rows_rejected=3)

    def broken(d):
        raise RuntimeError("disk full")
    with pytest.raises(RuntimeError, match="disk full"):
        log.write("fact_x", "LOAD", src, broken)
    rows = {r["table_name"]: r for r in log.to_df().collect()}
    assert (rows["stg_x"]["status"], rows["stg_x"]["rows_inserted"]) == ("SUCCESS", 10)
    d = rows["dim_x"]
    assert (d["rows_extracted"], d["rows_inserted"], d["rows_rejected"]) == (10, 7, 3)
    f = rows["fact_x"]
    assert f["status"] == "FAILED" and "disk full" in f["error_message"] and f["rows_inserted"] == 0
    log.save(f"{root}/etl_log")
    saved = spark.read.parquet(f"{root}/etl_log")
    assert saved.filter(F.col("status") == "FAILED").count() == 1
    assert saved.select("run_id").distinct().count() == 1 and saved.count() == 3
