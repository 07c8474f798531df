"""What a load moves: only rows whose id repeats are grouped, a dimension's keys
are broadcast by their counted size, and both give the same rows as one group per key."""

from collections import Counter

from telco_mart.operators import lookup
from telco_mart.operators.lookup import sized
from telco_mart.operators.scd import latest_per_key, one_per_key
from telco_mart.session import scratch_path


def _written(spark, rows, name):
    path = scratch_path(spark, name)
    spark.createDataFrame(rows, "id string, a int, b string").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_repeats_are_not_moved(spark):
    df = _written(spark, [(f"u{i}", i, None) for i in range(50)], "once")
    one = one_per_key(df, "id")
    assert "Exchange" not in _plan(one) and "Exchange" in _plan(latest_per_key(df, "id"))
    assert Counter(one.collect()) == Counter(df.collect())


def test_repeated_and_null_ids_keep_the_largest_row(spark, monkeypatch):
    rows = [(f"u{i}", i, "x") for i in range(20)] + [("u3", 3, "x"), ("u4", 9, None), ("u4", 9, "a"), (None, 1, "p"), (None, None, "q")]
    df = _written(spark, rows, "again")
    want = Counter(latest_per_key(df, "id").collect())
    assert want[("u4", 9, "a")] == 1 and want[(None, 1, "p")] == 1 and sum(want.values()) == 21
    for most in (20_000, 1):
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", most)
        assert Counter(one_per_key(df, "id").collect()) == want


def test_the_row_is_held_once_while_grouped(spark):
    df = _written(spark, [("u1", 1, "x")], "single")
    assert "max_by" not in _plan(latest_per_key(df, "id"))


def test_keys_are_broadcast_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_KEYS", 3)
    df = _written(spark, [(f"u{i}", i, None) for i in range(5)], "keys")
    hinted = lambda d: "strategy=broadcast" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(sized(df.limit(3))) and not hinted(sized(df))


def test_run_tables_are_zstd(spark):
    import glob

    from telco_mart.operators.runs import Run

    root = scratch_path(spark, "zstd_run")
    Run(spark, root).replace("t", spark.range(5))
    assert glob.glob(f"{root}/t/*/*.zstd.parquet")


def test_facts_built_from_the_feeds_group_only_repeated_ids(spark, monkeypatch):
    """Without a written load, too, whole usage rows are not grouped by their id:
    repeated rows of the feed give the same fact."""
    from conftest import SMALL
    from telco_mart.operators import facts
    from telco_mart.plans.warehouse import Warehouse

    def grouped(*args):
        raise AssertionError("all usage rows are grouped")

    monkeypatch.setattr(facts, "latest_per_key", grouped)
    once = Warehouse(spark, SMALL)
    raw = once.raw("usage")
    again = Warehouse(spark, SMALL, feeds={"usage": raw.unionByName(raw.filter("usage_id like '%3-1-%'"))})
    columns = ["usage_id", "date_sk", "subscriber_sk", "tower_sk"]
    want, got = (Counter(w.fact_usage.select(*columns).collect()) for w in (once, again))
    assert sum(got.values()) > 0 and max(got.values()) == 1 and got == want


def test_incidents_group_only_repeated_ids(spark, monkeypatch):
    from conftest import SMALL
    from telco_mart.operators import facts
    from telco_mart.plans.warehouse import Warehouse

    def grouped(*args):
        raise AssertionError("all incident rows are grouped")

    monkeypatch.setattr(facts, "latest_per_key", grouped)
    once = Warehouse(spark, SMALL)
    raw = once.raw("incidents")
    again = Warehouse(spark, SMALL, feeds={"incidents": raw.unionByName(raw.filter("incident_id like '%3'"))})
    want, got = (Counter(w.fact_incident.select("incident_id", "date_sk", "tower_sk", "description").collect()) for w in (once, again))
    assert sum(got.values()) > 0 and max(got.values()) == 1 and got == want


def test_appends_of_a_written_batch_group_only_repeated_ids(spark):
    from telco_mart.operators.facts import append_new

    target = _written(spark, [("u1", 1, "x"), ("u2", 2, "x")], "append_target")
    once = _written(spark, [(f"u{i}", i, "x") for i in range(6)], "append_once")
    twice = _written(spark, [("u1", 5, "y"), ("u3", 3, "x"), ("u3", 3, None), ("u4", 4, "x"), (None, 1, "p"), (None, 2, None)], "append_twice")
    for batch in (once, twice):
        assert Counter(append_new(target, batch, "id", written=True).collect()) == Counter(append_new(target, batch, "id").collect())
    assert "Aggregate" not in _plan(append_new(target, once, "id", written=True)) and "Aggregate" in _plan(append_new(target, once, "id"))
