"""Distributed exact median: agrees with Spark's exact percentile on odd and
even groups, ties, a single value, skewed spreads, NULL values and groups,
and over the whole range of doubles."""

import random

import pytest
from pyspark.sql import functions as F

from telco_mart.operators.median import group_medians


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for g, n in enumerate([1, 2, 9, 400, 801]):
        for _ in range(n):
            v = (rnd.choice([1.0, 2.0, 2.0, 3.5]) if g % 3 == 0 else
                 rnd.expovariate(0.001) if g % 3 == 1 else round(rnd.gauss(100, 30), 2))
            rows.append((g, v))
    rows += [(None, 5.0), (1, None), (9, None)]
    # infinities (text such as "1e400" parses to +inf) and extreme magnitudes
    inf = float("inf")
    rows += [(20, -inf), (20, -inf), (20, 3.0), (20, inf)]          # -inf and 3.0 in the middle
    rows += [(21, -inf), (21, inf)]                                    # NaN, as percentile gives
    rows += [(22, 1.5e308), (22, -1.5e308), (22, 0.0), (22, 1e-300), (22, 7.0), (22, inf)]
    rows += [(23, float(i)) for i in range(50)] + [(23, inf)] * 3 + [(23, -inf)]
    return spark.createDataFrame(rows, "g int, v double")


def test_group_medians_match_percentile(spark, data):
    want = {r["g"]: r["m"] for r in data.groupBy("g").agg(F.median("v").alias("m")).collect()
            if r["g"] is not None and r["m"] is not None}
    got = {r["g"]: r["median"] for r in group_medians(data, "v", "g").collect()}
    assert set(got) == set(want)
    for g in want:  # NaN == NaN for the +inf/-inf middle pair
        assert got[g] == want[g] or (got[g] != got[g] and want[g] != want[g]), (g, got[g], want[g])


def test_global_median_and_impute(spark, data):
    from telco_mart.operators.cleaning import impute_global_median
    assert group_medians(data, "v").first()["median"] == data.agg(F.median("v")).first()[0]
    filled = impute_global_median(data, "v")
    assert filled.filter(F.col("v").isNull()).count() == 0


def test_values_spread_over_the_whole_double_range(spark):
    rnd = random.Random(3)
    vals = [rnd.choice([-1, 1]) * rnd.uniform(1, 2) * 2.0 ** rnd.randrange(-1074, 1023) for _ in range(2001)]
    vals += [2.0 ** e for e in range(-1074, 1024, 7)] + [-(2.0 ** e) for e in range(-1074, 1024, 5)]
    vals += [5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, 0.0, -0.0]
    df = spark.createDataFrame([(i % 5, v) for i, v in enumerate(vals)], "g int, v double")
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert {r["g"]: r["median"] for r in group_medians(df, "v", "g").collect()} == want


def test_many_groups_are_not_broadcast(spark, monkeypatch):
    from telco_mart.operators import lookup
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 3)
    df = spark.range(4000).select((F.col("id") % 40).alias("g"), (F.col("id") * 7919 % 1000).cast("double").alias("v"))
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert {r["g"]: r["median"] for r in group_medians(df, "v", "g").collect()} == want
