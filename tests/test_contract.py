"""Schema contracts, day gaps, bitmap counts and the landing ledger on literal rows."""

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from telco_mart.operators import actives as A
from telco_mart.operators import quality as Q
from telco_mart.operators.contract import FEEDS, SNAPSHOT, Contract, Field
from telco_mart.operators.runs import Run, RunStore
from telco_mart.plans import etl
from telco_mart.schemas import RAW_COLUMNS
from telco_mart.session import scratch_path
from telco_mart.sources.landing import land

from conftest import SMALL


def test_violations_are_reported_and_defaults_filled(spark):
    contract = Contract("t", "id", {
        "id": Field("string", 4, required=True, strict=True), "n": Field("int", default=7), "price": Field("decimal(4,2)"),
        "name": Field("string", 3, default="?"), "must": Field("int", required=True), "extra": Field("string", default="none")}, parse=True)
    df = spark.createDataFrame([
        ("a", "1", "9.99", "abc", "1"), ("b", "3000000000", "100", "abcd", None), ("c", None, None, None, "x"), (None, "1", "1", "a", "1"), ("toolong", "1", "1", "a", "1"),
    ], "id string, n string, price string, name string, must string")
    kept, report = contract.fit(df)
    assert {r.id: (r.n, r.price and float(r.price), r.name, r.must, r.extra) for r in kept.collect()} == {
        "a": (1, 9.99, "abc", 1, "none"), "b": (7, None, "abc", None, "none"), "c": (7, None, "?", None, "none")}
    assert [f.dataType.simpleString() for f in kept.schema] == ["string", "int", "decimal(4,2)", "string", "int", "string"]
    got = Counter((r.record_id, r.rejection_reason) for r in report.collect())
    assert got == Counter([("b", "n : hors type int"), ("b", "price : hors type decimal(4,2)"), ("b", "name : texte trop long (3)"), ("b", "must : valeur obligatoire absente"),
                           ("c", "must : valeur obligatoire absente"), (None, "id : valeur obligatoire absente"), ("toolong", "id : texte trop long (4)")])
    assert '"price":"100"' in report.filter("record_id = 'b'").first().raw_data
    assert contract.fit(df.limit(0))[0].collect() == []


def test_contracts_name_real_columns(spark):
    assert set(FEEDS) == set(RAW_COLUMNS) and all(set(c.fields) <= set(RAW_COLUMNS[n]) for n, c in FEEDS.items())


def test_a_snapshot_sum_that_does_not_fit_ends_in_the_rejects(spark, monkeypatch):
    whole = etl.SN.monthly_snapshots
    huge = lambda *a, **k: whole(*a, **k).withColumn("voice_used_sec", F.when(F.col("snapshot_month") == "2001-11", F.col("voice_used_sec") + 3_000_000_000).otherwise(F.col("voice_used_sec")))
    monkeypatch.setattr(etl.SN, "monthly_snapshots", huge)
    root = scratch_path(spark, f"t_contract_{uuid.uuid4().hex[:8]}")
    etl.run_etl(spark, SMALL, root, marts=False)
    store = RunStore(spark, root)
    stored = store.read("fact_subscriber_monthly").filter("snapshot_month = '2001-11'")
    rejected = store.read("rejected_rows").filter("source_table = 'fact_subscriber_monthly'")
    assert stored.filter("voice_used_sec <> 0").count() == 0 and stored.count() == rejected.count() > 0
    assert {r.rejection_reason for r in rejected.collect()} == {"voice_used_sec : hors type int"}
    assert store.read("fact_subscriber_monthly").schema["voice_used_sec"].dataType.simpleString() == SNAPSHOT.fields["voice_used_sec"].type


def test_day_gaps(spark):
    rows = [("a", "2020-01-01"), ("a", "2020-01-02"), ("a", "2020-01-05"), ("a", "2020-01-05"), ("a", None), ("b", "2020-01-01"), ("c", "2020-02-28"), ("c", "2020-03-01"), (None, "2020-01-01"), (None, "2020-01-03")]
    got = {(r.source, str(r.gap_start), str(r.gap_end), r.days) for r in Q.day_gaps(spark.createDataFrame(rows, "source string, day string")).collect()}
    assert got == {("a", "2020-01-03", "2020-01-04", 2), ("c", "2020-02-29", "2020-02-29", 1), (None, "2020-01-02", "2020-01-02", 1)}


def test_bitmaps_add_up_exactly(spark):
    dim = spark.range(70_000).selectExpr("id * 10 AS subscriber_sk", "concat('S', id div 2) AS subscriber_id")  # two versions each
    numbers = A.ordinals(dim)
    assert sorted({r.number for r in numbers.filter("subscriber_sk < 100 or subscriber_sk >= 699900").collect()})[0] >= 1
    assert numbers.agg(F.max("number"), F.countDistinct("number")).first()[:] == (35_000, 35_000)
    cells = spark.range(200_000).selectExpr("id % 12 AS month", "id % 5 AS place", "(id * 7919 % 70000) * 10 AS subscriber_sk")
    table = A.bitmaps(cells, numbers, ["month", "place"]).cache()
    named = cells.join(dim, "subscriber_sk")
    for by in (["month", "place"], ["month"], ["place"]):
        want = {tuple(r[c] for c in by): r.n for r in named.groupBy(*by).agg(F.countDistinct("subscriber_id").alias("n")).collect()}
        assert {tuple(r[c] for c in by): r.actives for r in A.count_active(table, by).collect()} == want
    first, second = (A.bitmaps(cells.filter(f"subscriber_sk % 20 = {k}"), numbers, ["month"]) for k in (0, 10))
    assert A.count_active(first.union(second), ["month"]).orderBy("month").collect() == A.count_active(table, ["month"]).orderBy("month").collect()


def test_landing_takes_each_content_once(spark):
    root = scratch_path(spark, f"t_land_{uuid.uuid4().hex[:8]}")
    head = ",".join(RAW_COLUMNS["plans"])
    text = lambda name, *lines: spark.createDataFrame([(x,) for x in (head, *lines)], "value string").coalesce(1).write.text(f"{root}/in/{name}")
    text("one", "P1,Basic,Ghana,10,1,1,1,x", "P2,only two", "P3,\"a, b\",Ghana,10,1,1,1,x")
    text("copy", "P1,Basic,Ghana,10,1,1,1,x", "P2,only two", "P3,\"a, b\",Ghana,10,1,1,1,x")
    run = Run(spark, f"{root}/wh")
    rows, broken = land(run, "plans", f"{root}/in")
    assert sorted((r.plan_id, r.plan_name) for r in rows.collect()) == [("P1", "Basic"), ("P3", "a, b")]
    assert [(r.raw_data, r.rejection_reason) for r in broken.collect()] == [("P2,only two", "ligne illisible")]
    assert rows.filter("_loaded_at is null or _source_file not like '%/in/%'").count() == 0
    broken_run = Run(spark, f"{root}/wh")  # a run that never commits lands nothing
    land(broken_run, "plans", f"{root}/in")
    run.commit()
    text("more", "P4,New,Ghana,10,1,1,1,x")
    second = Run(spark, f"{root}/wh")
    rows, broken = land(second, "plans", f"{root}/in")
    assert [r.plan_id for r in rows.collect()] == ["P4"] and broken.count() == 0
    second.commit()
    third = Run(spark, f"{root}/wh")
    rows, broken = land(third, "plans", f"{root}/in")
    assert rows.count() == 0 and broken.count() == 0
    store = RunStore(spark, f"{root}/wh")
    assert store.read("landed_plans").count() == 4 and store.read("landing_ledger").count() == 2
