"""A usage feed that no run has written is joined and parsed once."""

from collections import Counter

from conftest import SMALL
from telco_mart.operators import cleaning as CL
from telco_mart.plans.warehouse import Warehouse


def test_cleaning_reads_the_feed_once(spark):
    w = Warehouse(spark, SMALL)
    kept, rejected = w._usage
    for df in (kept, rejected, w.fact_usage):
        assert "lineitem.parquet" not in df._jdf.queryExecution().executedPlan().toString()
    want, lost = CL.clean_usage(w.raw("usage"), w.subscribers, w.towers)
    assert kept.schema.simpleString() == want.schema.simpleString()
    assert Counter(kept.collect()) == Counter(want.collect()) and Counter(rejected.collect()) == Counter(lost.collect())


def test_parsed_rows_keep_odd_values(spark):
    old = ("u1", "SUB1", "T1", "Data", "1850-02-03 04:05:06", "-7", "1e308", None, None, "", "1")
    rows = [old, ("u2", None, "T1", "Data", "0001-01-01", None, "x", "3.5", "é", "4G", None), ("u2", None, "T1", "Data", "9999-12-31 23:59:59", "9e99", "-0", "4.5", None, None, "0"), (None,) * 11]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CL.USAGE_COLUMNS))
    parsed = Warehouse(spark, SMALL, feeds={"usage": raw})
    shown = lambda df: Counter(df.select(*(df[c].cast("string") for c in df.columns)).collect())
    assert shown(parsed._usage_parsed) == shown(CL.type_usage(raw))
    assert shown(parsed._usage_typed) == shown(CL.typed_usage(raw))
    amounts = parsed._usage_typed.filter("event_type = 'Data'").select("amount_fcfa").collect()
    assert sorted(r.amount_fcfa for r in amounts) == [3.5, 4.0, 4.5]
