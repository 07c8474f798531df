"""Mixing sources to target weights by Poisson replication.

A document of source s is wanted ``rate(s) = weight(s) * total / rows(s)`` times
on average. Its number of copies is a Poisson variable with that mean, inverted
from a uniform number that a hash gives; above a mean of ``LARGEST`` it is the
sum of independent Poisson numbers of equal, smaller means, each from a hash of
its own, which is exactly Poisson. The hash is taken of the seed, a digest of the
row and the row's number among equal rows, so every row has a draw of its own,
whatever ids are missing or repeated, and the same input always gives the same
mixture, on any partitioning. Each document is exploded by its count, and copies
are shuffled globally by a hash of the same parts and the copy number.

Inputs: null sources are one source of their own; a source without a weight gets
weight zero; weights are normalised over the sources present; rows that are null
or repeat in some or all columns draw independent counts. Empty tables give empty
results. All columns pass through (the added ones win).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telco_mart.operators.lookup import join_lookup
from telco_mart.operators.prefix import running_totals

from .common import written

#: Means above this are split into equal parts, so that the inversion stays short.
LARGEST = 16


def hash_number(*parts: Column) -> Column:
    """Uniform integer below 2^52, from the MD5 of the parts joined by colons."""
    joined = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long")


def poisson(mean: Column, u: Column) -> Column:
    """Smallest k whose Poisson distribution function reaches u (0 <= u < 1), for
    a mean of at most LARGEST.

    The sum runs until the distribution function is 1 in double precision."""
    lam = mean.cast("double")
    start = F.struct(F.exp(-lam).alias("p"), F.exp(-lam).alias("cdf"), F.lit(0).cast("long").alias("k"))

    def step(acc: Column, i: Column) -> Column:
        p = acc["p"] * lam / i
        more = acc["cdf"] <= u
        return F.struct(p.alias("p"), (acc["cdf"] + p).alias("cdf"), (acc["k"] + F.when(more, 1).otherwise(0)).cast("long").alias("k"))

    terms = F.sequence(F.lit(1), F.lit(LARGEST * 4 + 16))
    return F.aggregate(terms, start, step, lambda acc: acc["k"])


def poisson_copies(mean: Column, seed: int, *row: Column) -> Column:
    """A Poisson number of any mean from the hash of seed and row: the parts after
    the first hash their number as well."""
    uniform = lambda *parts: hash_number(*parts) / F.lit(float(1 << 52))
    parts = F.greatest(F.ceil(mean / LARGEST), F.lit(1)).cast("long")
    draw = lambda u: F.struct((mean / parts).cast("double").alias("mean"), u.alias("u"))
    more = F.transform(F.sequence(F.lit(2).cast("long"), parts), lambda j: draw(uniform(F.lit(f"{seed}-part"), *row, j)))
    first = F.array(draw(uniform(F.lit(seed), *row)))
    draws = F.when(parts > 1, F.concat(first, more)).otherwise(first)
    return F.aggregate(draws, F.lit(0).cast("long"), lambda n, d: n + poisson(d["mean"], d["u"]))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__number``: 1, 2, ... among the rows of equal ``__row``.

    Digests are counted map-side. Where none repeats that is all; else only the
    repeated rows are numbered, over ranges of (digest, position), so that a
    digest of very many rows is spread over many tasks."""
    one = F.lit(1).cast("long")
    repeated = written(rows.groupBy("__row").agg(F.count("*").alias("__n")).filter("__n > 1").select("__row", one.alias("__again")), "repeated_rows")
    if not repeated.count():
        return rows.withColumn("__number", one)
    found = join_lookup(rows, repeated, ["__row"])
    once = found.filter("__again is null").drop("__again").withColumn("__number", one)
    again = written(found.filter("__again is not null").withColumn("__position", F.monotonically_increasing_id()), "repeats")
    totals = running_totals(again.select("__row", "__position", "__again"), F.struct("__row", "__position"), {"__again": "__upto"})
    first = totals.groupBy("__row").agg(F.min("__upto").alias("__first"))
    number = join_lookup(totals, written(first, "first_rows"), ["__row"]).select("__position", (F.col("__upto") - F.col("__first") + 1).alias("__number"))
    return once.unionByName(again.drop("__again").join(number, "__position").drop("__position"))


def source_rates(df: DataFrame, source_col: str = "source", weights: DataFrame | None = None, temperature: float = 0.5,
                 total: int | None = None) -> DataFrame:
    """(source, n, weight, rate): target weights given as (source, weight), or
    rows(s) ** temperature; ``total`` is the wanted size (default: as many rows
    as there are). One row per source, from a map-side aggregate."""
    n = df.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        w = n.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        w = n.join(weights.groupBy(F.col("source").alias("__s")).agg(F.sum("weight").alias("w")), F.col("source").eqNullSafe(F.col("__s")), "left").select(
            "source", "n", F.coalesce(F.col("w").cast("double"), F.lit(0.0)).alias("w"))
    w = written(w, "source_weights")
    size = F.lit(total) if total is not None else w.agg(F.sum("n")).scalar()
    all_w = w.agg(F.sum("w")).scalar()
    weight = F.when(all_w > 0, F.col("w") / all_w).otherwise(F.lit(0.0))
    return w.select("source", "n", weight.alias("weight"), (weight * size / F.col("n")).alias("rate"))


def mix(df: DataFrame, rates: DataFrame, seed: int = 0, source_col: str = "source") -> DataFrame:
    """All columns of ``df`` and rate, copies, copy (1..copies), shuffle_key:
    one row per copy, globally shuffled (ordered by shuffle_key)."""
    added = ("rate", "copies", "copy", "shuffle_key")
    kept = [c for c in df.columns if c.lower() not in added]
    digest = F.md5(F.concat_ws("\x1f", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")) for c in kept)).cast("binary"))
    rows = numbered(df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{source_col}`").alias("__mix_source"), digest.alias("__row")))
    keyed = join_lookup(rows, rates.select(F.col("source").alias("__mix_source"), "rate"), ["__mix_source"])
    row = (F.col("__row"), F.col("__number"))
    counted = keyed.withColumn("copies", poisson_copies(F.coalesce("rate", F.lit(0.0)), seed, *row)).filter("copies > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    shuffled = copies.withColumn("shuffle_key", hash_number(F.lit(f"{seed}-order"), *row, F.col("copy"))).drop("__row", "__number", "__mix_source")
    return shuffled.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key")
