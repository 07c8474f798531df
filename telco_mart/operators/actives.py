"""Exact distinct subscribers that can be added up: bitmaps over dense numbers.

Subscribers get dense numbers by running totals. The active ones of each cell
(month, place, technology, ...) are kept as bitmaps of 32,768 numbers each, made
and merged by Spark's bitmap aggregates. Cells roll up over any of their
columns by OR, so monthly, yearly and regional distinct counts come from one
small table instead of a ``countDistinct`` over the fact for each of them; a run
that adds facts adds bitmaps of its rows, which OR with those before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telco_mart.operators.prefix import running_totals


def ordinals(dim: DataFrame, identity: str = "subscriber_id", key: str = "subscriber_sk") -> DataFrame:
    """(key, number): 1, 2, ... by identity, the same for all versions of one."""
    ids = dim.select(identity).filter(F.col(identity).isNotNull()).distinct().withColumn("one", F.lit(1).cast("long"))
    numbered = running_totals(ids, F.col(identity), {"one": "number"}).select(identity, "number")
    return dim.select(key, identity).join(numbered, identity).select(key, "number")


def bitmaps(cells: DataFrame, numbers: DataFrame, by: list[str], key: str = "subscriber_sk") -> DataFrame:
    """(by..., bucket, bitmap) of rows (by..., key): repeated rows count once.
    Rows are collapsed map-side before they meet the numbers."""
    distinct = cells.select(*by, key).distinct().join(numbers, key)
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return distinct.groupBy(*by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def merge(tables: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser cells: OR over the columns left out."""
    return tables.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_active(tables: DataFrame, by: list[str], name: str = "actives") -> DataFrame:
    """(by..., name): distinct subscribers of each cell."""
    return merge(tables, by).groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
