"""Rows that a mart shuffles carry the month's key, not its names."""

import datetime as dt
from decimal import Decimal as Dec

from telco_mart.operators import marts as M
from telco_mart.operators.calendar import build_calendar


def _tables(spark):
    day = dt.date(2024, 1, 1)
    usage = spark.createDataFrame(
        [(i, k, 1 + i % 2, 10 + i % 2, 100, 20, e, "3G", 60, "Succès", Dec("10.00"), Dec("1024.0000"), Dec("1.000000"))
         for i, (k, e) in enumerate([(20240105, "Data"), (20240131, "Appel_Sortant"), (20240201, "Data"), (20240210, "Data"), (20240211, "Appel_Entrant"), (20250101, "Data")])],
        "usage_sk long, date_sk int, subscriber_sk long, plan_sk long, tower_sk long, location_sk long, event_type string, network_type string, "
        "duration_sec int, status string, amount_fcfa decimal(12,2), data_mb decimal(12,4), data_gb decimal(12,6)")
    sub = spark.createDataFrame([(1, "C", "A", "S"), (2, "C", "A", "S")], "subscriber_sk long, country string, city string, segment string")
    plan = spark.createDataFrame([(10, "P", "x"), (11, "P", "x")], "plan_sk long, plan_name string, type_abonnement string")
    loc = spark.createDataFrame([(20, "C", "A", "R")], "location_sk long, country string, city string, region string")
    tower = spark.createDataFrame([(100, "4G")], "tower_sk long, technology string")
    return usage, sub, plan, loc, tower, build_calendar(spark, str(day), "2024-12-31", "a")


def test_names_of_the_month_are_not_shuffled(spark):
    usage, sub, plan, loc, tower, cal = _tables(spark)
    for mart in (M.kpi_arpu(usage, sub, plan, cal), M.kpi_duree_appels(usage, sub, cal), M.kpi_data_par_region(usage, loc, tower, cal)):
        keys = [line for line in mart._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in line]
        assert any("month_key" in k for k in keys) and not any("nom_mois" in k for k in keys)


def test_groups_are_those_of_the_months(spark):
    usage, sub, plan, loc, tower, cal = _tables(spark)
    arpu = {(r.annee, r.mois): (r.nb_abonnes_actifs, r.revenu_total, r.arpu) for r in M.kpi_arpu(usage, sub, plan, cal).collect()}
    assert arpu == {(2024, 1): (2, 20.0, 10.0), (2024, 2): (2, 30.0, 15.0)}  # a day outside the calendar is left out
    calls = {(r.mois, r.tranche_horaire, r.nb_appels) for r in M.kpi_duree_appels(usage, sub, cal).collect()}
    assert calls == {(1, None, 1), (2, None, 1)}
    data = {(r.mois, r.abonnes_data, r.nb_sessions_data, r.total_gb) for r in M.kpi_data_par_region(usage, loc, tower, cal).collect()}
    assert data == {(1, 1, 1, 1.0), (2, 2, 2, 2.0)}
