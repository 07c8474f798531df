"""What a stream's batch moves: repeated ids give one row without grouping all rows."""

import glob
from collections import Counter

from conftest import SMALL
from telco_mart.operators import facts
from telco_mart.plans.warehouse import Warehouse
from telco_mart.session import scratch_path
from telco_mart.streaming.ingest import ingest_usage


def test_a_batch_groups_only_repeated_ids_and_writes_zstd(spark, monkeypatch):
    def grouped(*args):
        raise AssertionError("all usage rows are grouped")

    w = Warehouse(spark, SMALL).materialize(scratch_path(spark, "stream_size_wh"))
    monkeypatch.setattr(facts, "latest_per_key", grouped)
    root = scratch_path(spark, "stream_size")
    raw = w.raw("usage").filter("usage_id like '%3-1-%'").drop("_loaded_at", "_source_file")
    raw.unionByName(raw.filter("usage_id like '%5'")).coalesce(1).write.parquet(f"{root}/in")
    ingest_usage(spark, f"{root}/in", f"{root}/fact", f"{root}/ckpt", w)
    got = Counter(r.usage_id for r in spark.read.parquet(f"{root}/fact").select("usage_id").collect())
    want = Counter(r.usage_id for r in w.fact_usage.join(raw.select("usage_id").distinct(), "usage_id", "left_semi").select("usage_id").collect())
    assert got == want and sum(got.values()) > 0 and max(got.values()) == 1
    assert glob.glob(f"{root.removeprefix('file:')}/fact/*/*/*.zstd.parquet")
