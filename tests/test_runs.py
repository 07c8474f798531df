"""Runs are seen whole or not at all; marts are refreshed by month."""

import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from telco_mart.operators import facts as FA
from telco_mart.operators.runs import Run, RunStore
from telco_mart.plans import etl
from telco_mart.plans.warehouse import DRIVER_CONFIG, Warehouse
from telco_mart.session import scratch_path
from telco_mart.sources import driver_tables as DT

from conftest import SMALL


def rows(df):
    return sorted(map(str, df.collect()))


def test_tables_of_a_run(spark):
    root = scratch_path(spark, f"t_runs_{uuid.uuid4().hex[:8]}")
    with pytest.raises(FileNotFoundError):
        RunStore(spark, root).read("dim")
    run = Run(spark, root)
    run.replace("dim", spark.range(3).toDF("x"))
    run.append("fact", spark.createDataFrame([(1, 2000), (2, 2001)], "id int, annee int"), ["annee"])
    run.rewrite("month", spark.createDataFrame([("a", 1), ("b", 2)], "v string, m int"), ["m"])
    assert run.read("dim").count() == 3 and not RunStore(spark, root).has("dim")
    assert run.commit() == 1
    second = Run(spark, root)
    second.append("fact", spark.createDataFrame([(3, 2001)], "id int, annee int"), ["annee"])
    second.rewrite("month", spark.createDataFrame([("c", 2)], "v string, m int"), ["m"], emptied=[{"m": 1}])
    assert rows(second.loaded("fact")) == ["Row(id=3, annee=2001)"]
    old = RunStore(spark, root)
    assert old.read("fact").count() == 2 and rows(old.read("month")) == ["Row(v='a', m=1)", "Row(v='b', m=2)"]
    second.commit()
    new = RunStore(spark, root)
    assert new.read("fact").schema == old.read("fact").schema and new.number == 2
    assert rows(new.read("fact")) == ["Row(id=1, annee=2000)", "Row(id=2, annee=2001)", "Row(id=3, annee=2001)"]
    assert rows(new.read("month")) == ["Row(v='c', m=2)"] and new.read("dim").count() == 3
    plan = new.read("fact").filter("annee = 2000")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(annee" in plan


def test_empty_tables_and_conflicting_commits(spark):
    root = scratch_path(spark, f"t_runs_{uuid.uuid4().hex[:8]}")
    run, other = Run(spark, root), Run(spark, root)
    run.append("fact", spark.createDataFrame([], "id int, annee int"), ["annee"])
    run.rewrite("month", spark.createDataFrame([], "v string, m int"), ["m"])
    run.commit()
    store = RunStore(spark, root)
    assert store.read("fact").collect() == [] and store.read("month").collect() == []
    other.replace("dim", spark.range(1).toDF("x"))
    with pytest.raises(RuntimeError, match="another run"):
        other.commit()
    assert not RunStore(spark, root).has("dim")


def test_a_broken_run_changes_nothing_and_a_repeat_completes_it(spark, monkeypatch):
    """The run breaks after all dimensions are written and before the facts."""
    root = scratch_path(spark, f"t_crash_{uuid.uuid4().hex[:8]}")
    day1 = Warehouse(spark, SMALL)
    early = day1.raw("usage").filter("substring(usage_id, -1, 1) <> '1'")
    etl.run_etl(spark, SMALL, root, marts=False, feeds={"usage": early})
    names = ("dim_subscriber", "dim_plan", "dim_tower", "dim_location", "fact_usage", "fact_incident", "rejected_rows", "fact_subscriber_monthly")
    before = {n: rows(RunStore(spark, root).read(n)) for n in names}
    delta = {"subscribers": DT.raw_subscribers(day1.tables, delta=True), "towers": DT.raw_towers(day1.tables, delta=True)}
    cfg = replace(DRIVER_CONFIG, as_of="2002-01-01")

    def broken(*_):
        raise RuntimeError("executor lost")
    with monkeypatch.context() as m:
        m.setattr(FA, "split_usage", broken)
        with pytest.raises(RuntimeError, match="executor lost"):
            etl.run_etl(spark, SMALL, root, cfg, marts=False, feeds=delta)
    assert {n: rows(RunStore(spark, root).read(n)) for n in names} == before
    w, _, _ = etl.run_etl(spark, SMALL, root, cfg, marts=False, feeds=delta)
    after = RunStore(spark, root)
    assert after.read("fact_usage").count() == day1.fact_usage.count() > len(before["fact_usage"])
    assert after.read("dim_subscriber").filter("version = 2").count() > 0
    assert after.read("rejected_rows").select("run_id").distinct().count() <= 2


def test_only_touched_months_are_read_and_replaced(spark):
    root = scratch_path(spark, f"t_months_{uuid.uuid4().hex[:8]}")
    day1 = Warehouse(spark, SMALL)
    raw = day1.raw("usage")
    old = raw.filter("event_datetime < '1998-01-01'")
    etl.run_etl(spark, SMALL, root, feeds={"usage": old})
    first = RunStore(spark, root)
    w, kpis, log = etl.run_etl(spark, SMALL, root, feeds={"usage": raw.filter("event_datetime < '1998-03-01'")})
    new = RunStore(spark, root)
    kept, added = (set(s.folders("kpi_arpu")) for s in (first, new))
    assert {f.split("/", 1)[1] for f in added - kept} == {"annee=1998/mois=1", "annee=1998/mois=2"} and kept < added
    assert added - kept and new.folders("kpi_incidents_qualite") == first.folders("kpi_incidents_qualite")
    full = etl.MARTS["kpi_arpu"](w).select(kpis["kpi_arpu"].columns)
    assert rows(full) == rows(kpis["kpi_arpu"])
    part = etl.MARTS["kpi_arpu"](w.restricted("fact_usage", [199801, 199802]))
    files = [f for f in part.inputFiles() if "/fact_usage/" in f]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert files and "annee#" in plan.split("PartitionFilters: [", 1)[1].split("]")[0] and "1998" in plan
    stages = {r.table_name: r for r in log.collect()}
    assert stages["kpi_arpu"].rows_inserted == kpis["kpi_arpu"].filter("annee = 1998").count()


def test_changed_dimension_rows_touch_their_months(spark):
    """A moved tower changes the months of its facts, old ones too."""
    root = scratch_path(spark, f"t_dims_{uuid.uuid4().hex[:8]}")
    day1 = Warehouse(spark, SMALL)
    etl.run_etl(spark, SMALL, root)
    towers = day1.raw("towers").withColumn("technology", F.when(F.col("tower_id").endswith("1"), "6G").otherwise(F.col("technology")))
    w, kpis, _ = etl.run_etl(spark, SMALL, root, feeds={"towers": towers})
    for name in ("kpi_utilisation_reseau", "kpi_data_par_region", "kpi_incidents_qualite"):
        assert kpis[name].filter("technology = '6G'").count() > 0
        assert rows(etl.MARTS[name](w).select(kpis[name].columns)) == rows(kpis[name])


def test_impossible_dates_stay_out(spark):
    """One event in year 9999 neither stretches the calendar nor is loaded."""
    day1 = Warehouse(spark, SMALL)
    k = F.col("usage_id")
    some = day1.raw("usage").limit(50)
    bad = some.limit(2).withColumn("event_datetime", F.lit("9999-12-31 00:00:00")).withColumn("usage_id", F.concat(F.lit("X"), k))
    inc = day1.raw("incidents").limit(5)
    late = day1.raw("incidents").join(day1.raw("towers").select("tower_id"), "tower_id", "left_semi").select(inc.columns).limit(1).withColumn("incident_datetime", F.lit("0001-01-01 00:00:00")).withColumn("incident_id", F.lit("LATE"))
    w = Warehouse(spark, SMALL, feeds={"usage": some.unionByName(bad), "incidents": inc.unionByName(late)})
    assert w.calendar_span[1] < "2100" and w.calendar.count() < 366 * 30
    assert w.fact_usage.filter("annee > 2100").count() == 0 and w.fact_usage_rejects.filter("usage_id like 'X%' and rejection_reason = 'date invalide'").count() == 2
    assert w.fact_incident_rejects.filter("incident_id = 'LATE'").count() == 1 and w.fact_incident.filter("incident_id = 'LATE'").count() == 0
