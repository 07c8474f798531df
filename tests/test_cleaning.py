"""Literal fixtures of the cleaning and quality rules (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from telco_mart.functions import cleaning as X
from telco_mart.operators import cleaning as CL
from telco_mart.operators import quality as Q


def col_values(df, c):
    return [r[c] for r in df.collect()]


def test_age_and_band(spark):
    ages = ["13", "14", "24", "25", "34", "35", "49", "50", "101", "abc", None]
    df = spark.createDataFrame([(a,) for a in ages], "age string").select(
        X.valid_age("age").alias("a")).withColumn("band", X.age_band("a"))
    rows = df.collect()
    assert [r.a for r in rows] == [None, 14, 24, 25, 34, 35, 49, 50, None, None, None]
    assert [r.band for r in rows] == ["Inconnu", "16-24", "16-24", "25-34", "25-34", "35-49", "35-49",
                                      "50+", "Inconnu", "Inconnu", "Inconnu"]


def test_gender(spark):
    df = spark.createDataFrame([(" m",), ("F",), ("x",), (None,)], "g string")
    assert col_values(df.select(X.clean_gender("g").alias("g")), "g") == ["M", "F", "Inconnu", "Inconnu"]


def test_price_category(spark):
    bands = {"Burkina Faso": (10000.0, 25000.0)}
    rows = [("Burkina Faso", 9999.0), ("Burkina Faso", 10000.0), ("Burkina Faso", 24999.0),
            ("Burkina Faso", 25000.0), ("Burkina Faso", None),
            ("Ghana", 69.0), ("Ghana", 70.0), ("Ghana", 174.0), ("Ghana", 175.0)]
    df = spark.createDataFrame(rows, "country string, fee double")
    got = col_values(df.select(X.price_category("fee", "country", bands, (70.0, 175.0)).alias("c")), "c")
    assert got == ["Économique", "Standard", "Standard", "Premium", "Premium",
                   "Économique", "Standard", "Standard", "Premium"]


def test_group_median_imputation(spark):
    df = spark.createDataFrame([("Data", 10.0), ("Data", None), ("Data", 30.0), ("SMS", None)],
                               "event_type string, amount double")
    out = CL.impute_group_median(df, "amount", "event_type").orderBy("event_type", "amount").collect()
    data = sorted(r.amount for r in out if r.event_type == "Data")
    assert data == [10.0, 20.0, 30.0]
    assert [r.amount for r in out if r.event_type == "SMS"] == [None]


def test_global_median_is_exact(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    got = sorted(col_values(CL.impute_global_median(df, "v"), "v"))
    assert got == [1.0, 2.0, 2.5, 3.0, 10.0]


def test_email_and_flags(spark):
    df = spark.createDataFrame([("a@b.co",), ("a@b.c",), ("ab.co",), (None,)], "e string")
    assert col_values(df.select(X.valid_email("e").alias("e")), "e") == ["a@b.co", None, None, None]
    df = spark.createDataFrame([("True",), ("1",), ("false",), ("yes",), (None,)], "r string")
    assert col_values(df.select(X.parse_flag("r").alias("r")), "r") == [1, 1, 0, 0, 0]


def test_dates_and_numbers(spark):
    df = spark.createDataFrame([("2024-13-01",), ("2024-02-29",), ("",), ("2024-02-29 10:11:12",)], "d string")
    got = col_values(df.select(X.to_timestamp("d").alias("t")), "t")
    assert got[0] is None and got[2] is None
    assert got[1] == dt.datetime(2024, 2, 29) and got[3] == dt.datetime(2024, 2, 29, 10, 11, 12)
    df = spark.createDataFrame([("12.7",), ("nan",), ("Infinity",), (" 42 ",), ("1.0d",)], "n string")
    assert col_values(df.select(X.to_number("n").alias("n")), "n") == [12.7, None, None, 42.0, None]
    assert col_values(df.select(X.to_int("n", fill=0).alias("n")), "n") == [12, 0, 0, 42, 0]


def test_subscriber_rules(spark):
    rows = [("S1", 1, None, "a@b.c", "Accra", "Ghana", "x"),
            ("S2", 0, dt.date(2025, 1, 1), "a@b.co", "Accra", "Ghana", "M"),
            ("S3", 1, dt.date(2025, 1, 1), None, None, "Ghana", "F")]
    df = spark.createDataFrame(rows, "subscriber_id string, churn int, churn_date date, email string, "
                                     "city string, country string, gender string").withColumn("age", F.lit(30))
    clean, quarantine = Q.subscriber_rules("2026-06-01").apply(df)
    got = {r.subscriber_id: r for r in clean.collect()}
    assert got["S1"].churn_date == dt.date(2026, 6, 1) and got["S1"].email is None
    assert got["S1"].gender == "Inconnu"
    assert got["S2"].churn_date is None and got["S2"].email == "a@b.co"
    assert "S3" not in got
    q = quarantine.collect()
    assert [(r.record_id, r.rejection_reason) for r in q] == [("S3", "Ville ou pays manquant")]


def test_usage_rules_warn_keeps_row(spark):
    df = spark.createDataFrame([("U1", "Data", -5, -1.0, -3.0)],
                               "usage_id string, event_type string, duration_sec int, data_mb double, "
                               "amount_fcfa double")
    clean, quarantine = Q.usage_rules().apply(df)
    r = clean.collect()[0]
    assert (r.duration_sec, r.data_mb, r.amount_fcfa) == (0, 0.0, None)
    assert quarantine.count() == 1


def test_incident_and_tower_rules(spark):
    df = spark.createDataFrame([("I1", 0, 30, -2)], "incident_id string, resolved int, "
                                                    "resolution_minutes int, nb_abonnes_affectes int")
    r = Q.incident_rules().apply(df)[0].collect()[0]
    assert r.resolution_minutes is None and r.nb_abonnes_affectes == 0
    df = spark.createDataFrame([("T1", 91.0, -181.0, -1)], "tower_id string, latitude double, "
                                                           "longitude double, capacity_users int")
    r = Q.tower_rules().apply(df)[0].collect()[0]
    assert (r.latitude, r.longitude, r.capacity_users) == (None, None, 0)
