"""SCD merges, calendar, snapshots and governance on literal fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from telco_mart.operators import dimensions as D
from telco_mart.operators import governance as G
from telco_mart.operators.calendar import build_calendar, calendar_checks
from telco_mart.operators.scd import scd1_merge, scd2_initial, scd2_merge

SUB_SCHEMA = "subscriber_id string, city string, segment string, plan_id string, churn int, " \
             "churn_date date, monthly_revenue double, phone_number string, email string"


def subs(spark, rows):
    return spark.createDataFrame(rows, SUB_SCHEMA)


def merge(cur, inc, as_of):
    return scd2_merge(cur, inc, "subscriber_id", D.SUBSCRIBER_TRACKED, D.SUBSCRIBER_TYPE1, as_of, "sk")


def test_scd2_tracked_change_opens_version(spark):
    v1 = scd2_initial(subs(spark, [("S1", "Accra", "Particulier", "P006", 0, None, 10.0, "1", "a@b.co")]),
                      "subscriber_id", "2026-01-01", "sk")
    v2 = merge(v1, subs(spark, [("S1", "Kumasi", "Particulier", "P006", 0, None, 10.0, "1", "a@b.co")]),
               "2026-01-02")
    rows = sorted(v2.collect(), key=lambda r: r.version)
    assert [(r.version, r.is_current, r.city) for r in rows] == [(1, 0, "Accra"), (2, 1, "Kumasi")]
    assert rows[0].date_fin == dt.date(2026, 1, 2) and rows[1].date_debut == dt.date(2026, 1, 2)
    # same batch again: nothing changes
    v3 = merge(v2, subs(spark, [("S1", "Kumasi", "Particulier", "P006", 0, None, 10.0, "1", "a@b.co")]),
               "2026-01-03")
    assert sorted(map(tuple, v3.collect())) == sorted(map(tuple, v2.collect()))
    # exactly one current version per key, intervals do not overlap
    assert v3.filter("is_current = 1").groupBy("subscriber_id").count().collect()[0]["count"] == 1


def test_scd2_type1_overwrites_in_place(spark):
    v1 = scd2_initial(subs(spark, [("S1", "Accra", "Particulier", "P006", 0, None, 10.0, "1", None)]),
                      "subscriber_id", "2026-01-01", "sk")
    v2 = merge(v1, subs(spark, [("S1", "Accra", "Particulier", "P006", 0, None, 99.0, "1", "x@y.zz")]),
               "2026-01-02")
    r = v2.collect()
    assert len(r) == 1 and r[0].monthly_revenue == 99.0 and r[0].email == "x@y.zz" and r[0].version == 1
    audit = G.audit_diff(v1, v2, "dim_subscriber", "subscriber_id", {"monthly_revenue": True, "churn": False})
    assert [(a.column_name, a.old_value, a.new_value) for a in audit.collect()] == [
        ("monthly_revenue", "10.0", "99.0")]


def test_scd2_plan_ignores_untracked(spark):
    schema = "plan_id string, plan_name string, monthly_fee double"
    p1 = scd2_initial(spark.createDataFrame([("P1", "Starter", 5000.0)], schema), "plan_id", "2026-01-01", "sk")
    p2 = scd2_merge(p1, spark.createDataFrame([("P1", "Starter", 5500.0)], schema), "plan_id",
                    D.PLAN_TRACKED, [], "2026-01-02", "sk")
    assert p2.filter("is_current = 1").collect()[0].version == 2
    p3 = scd2_merge(p2, spark.createDataFrame([("P1", "Renamed", 5500.0)], schema), "plan_id",
                    D.PLAN_TRACKED, [], "2026-01-03", "sk")
    assert sorted(map(tuple, p3.collect())) == sorted(map(tuple, p2.collect()))


def test_scd1_keeps_installation_date(spark):
    schema = "tower_id string, status string, installation_date date"
    cur = spark.createDataFrame([("T1", "Actif", dt.date(2015, 1, 1))], schema).withColumn("tower_sk", F.lit(1))
    inc = spark.createDataFrame([("T1", "Inactif", dt.date(2016, 1, 1)), ("T2", "Actif", dt.date(2017, 1, 1))],
                                schema)
    out = {r.tower_id: r for r in scd1_merge(cur, inc, "tower_id", ["installation_date"], "tower_sk").collect()}
    assert out["T1"].status == "Inactif" and out["T1"].installation_date == dt.date(2015, 1, 1)
    assert out["T2"].tower_sk is not None


def test_calendar_styles(spark):
    a = {r.date_complete: r for r in build_calendar(spark, "2024-08-05", "2024-12-30").collect()}
    b = {r.date_complete: r for r in build_calendar(spark, "2024-10-15", "2024-12-30", "b").collect()}
    d = dt.date(2024, 12, 30)
    assert (a[d].jour_semaine, a[d].semaine_annee) == (1, 1)
    assert (b[d].jour_semaine, b[d].semaine_annee) == (2, 53)
    assert a[dt.date(2024, 10, 15)].saison == "Saison sèche" and b[dt.date(2024, 10, 15)].saison == "Hivernage"
    h = a[dt.date(2024, 8, 5)]
    assert (h.is_ferie, h.is_jour_ouvre) == (1, 0)
    c = calendar_checks(build_calendar(spark, "2023-01-01", "2027-12-31")).collect()[0]
    assert (c.nb_jours_total, c.nb_weekends, c.nb_feries) == (1826, 521, 30)
    assert build_calendar(spark, "2015-01-01", "2035-12-31", "b").count() == 7670


def test_pseudonymise_all_versions(spark):
    dim = spark.createDataFrame(
        [("S1", 1, "A", "B", "A B", "1", "e@x.yz"), ("S1", 2, "A", "B", "A B", "1", "e@x.yz"),
         ("S2", 1, "C", "D", "C D", "2", None)],
        "subscriber_id string, version int, first_name string, last_name string, nom_complet string, "
        "phone_number string, email string")
    out, audit = G.pseudonymise(dim, spark.createDataFrame([("S1",)], "subscriber_id string"))
    s1 = [r for r in out.collect() if r.subscriber_id == "S1"]
    assert len(s1) == 2 and all(r.first_name == "ANONYMISE" and r.email is None for r in s1)
    assert audit.count() == 1


def test_guarded_delete(spark):
    dim = spark.createDataFrame([("S1", 11), ("S2", 12)], "subscriber_id string, subscriber_sk long")
    fact = spark.createDataFrame([(11,)], "subscriber_sk long")
    req = spark.createDataFrame([("S1",), ("S2",)], "subscriber_id string")
    remaining, refused, deleted = D.guarded_delete(dim, req, "subscriber_id", fact, "subscriber_sk")
    assert [r.subscriber_id for r in refused.collect()] == ["S1"]
    assert [r.subscriber_id for r in deleted.collect()] == ["S2"]
    assert [r.subscriber_id for r in remaining.collect()] == ["S1"]


def test_skip_unchanged_keeps_type1(spark):
    v1 = scd2_initial(subs(spark, [("S1", "Accra", "Particulier", "P006", 0, None, 10.0, "1", None)]),
                      "subscriber_id", "2026-01-01", "sk")
    inc = subs(spark, [("S1", "Accra", "Particulier", "P006", 0, None, 99.0, "1", None)])
    out = scd2_merge(v1, inc, "subscriber_id", D.SUBSCRIBER_TRACKED, D.SUBSCRIBER_TYPE1, "2026-01-02", "sk",
                     skip_unchanged=True)
    assert out.collect()[0].monthly_revenue == 10.0


def test_snapshot_by_natural_key(spark):
    from telco_mart.operators.snapshots import monthly_snapshots
    dim = spark.createDataFrame(
        [(1, "S1", "T1", 0, None, 0), (2, "S1", "T1", 0, None, 1)],
        "subscriber_sk long, subscriber_id string, tower_id string, churn int, churn_date date, is_current int")
    towers = spark.createDataFrame([("T1", 7)], "tower_id string, tower_sk long")
    usage = spark.createDataFrame(
        [(1, 20260510, 9, 0.0, 60, "Appel_Sortant", 2.0, "Succès")],
        "subscriber_sk long, date_sk int, plan_sk long, data_mb double, duration_sec int, event_type string, "
        "amount_fcfa double, status string")
    inc = spark.createDataFrame([], "tower_sk long, date_sk int")
    by_sk = monthly_snapshots(dim, towers, usage, inc, ["2026-05"]).collect()[0]
    by_id = monthly_snapshots(dim, towers, usage, inc, ["2026-05"], by="subscriber_id").collect()[0]
    assert (by_sk.subscriber_sk, by_sk.voice_used_sec) == (2, 0)
    assert (by_id.subscriber_sk, by_id.voice_used_sec) == (2, 60)


def test_latest_per_key_within_batch(spark):
    from telco_mart.operators.scd import latest_per_key
    df = spark.createDataFrame([("S1", 1, "a"), ("S1", 3, "c"), ("S1", 2, "b"), ("S2", 1, "z")],
                               "k string, seq int, v string")
    got = {r.k: r.v for r in latest_per_key(df, "k", ["seq"]).collect()}
    assert got == {"S1": "c", "S2": "z"}
