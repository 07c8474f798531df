"""Left join to a lookup table, broadcast only when its counted size allows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a lookup table up to which it may be broadcast (a few MB).
BROADCAST_ROWS = 20_000
#: Rows of a dimension's key columns up to which they may be broadcast (about 40 MB).
BROADCAST_KEYS = 400_000


def sized(side: DataFrame, most: int | None = None) -> DataFrame:
    """``side`` (narrow rows of a written dimension) for the right of a join:
    broadcast if it counts at most ``most`` rows (``BROADCAST_KEYS``), else left to
    the planner."""
    most = BROADCAST_KEYS if most is None else most
    return F.broadcast(side) if side.limit(most + 1).count() <= most else side


def join_lookup(df: DataFrame, lookup: DataFrame, keys: list[str], salts: int = 1, rows: int | None = None, most: int | None = None) -> DataFrame:
    """``df`` with the other columns of ``lookup`` (one row per key, null keys
    equal); rows without a match get nulls.

    The lookup is counted first (unless the caller knows a bound, ``rows``): up to
    ``most`` rows (``BROADCAST_ROWS``) it is broadcast and ``df`` is not shuffled;
    a larger one is merged with ``df`` by key and never broadcast, whatever its
    estimated size. Adaptive execution splits the partition of a key with very many
    rows; without it, ``salts`` deals such a key over as many tasks, at the price of
    as many copies of the lookup.
    """
    side = lookup.select(*(F.col(k).alias(f"__lookup_{k}") for k in keys), *(c for c in lookup.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"__lookup_{k}")) for k in keys]
    most = BROADCAST_ROWS if most is None else most
    if (side.limit(most + 1).count() if rows is None else rows) <= most:
        side = F.broadcast(side)
    elif salts > 1:
        side = side.withColumn("__lookup_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(salts)) + F.spark_partition_id()  # equal rows of different partitions part ways
        df = df.withColumn("__salt", F.pmod(spread, F.lit(salts)).cast("int"))
        on.append(F.col("__salt") == F.col("__lookup_salt"))
    else:
        side = side.hint("merge")
    return df.join(side, reduce(lambda a, b: a & b, on), "left").drop("__salt", "__lookup_salt", *(f"__lookup_{k}" for k in keys))
