"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telco_mart.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other alphabets)."""
    return F.translate(col, UPPER, LOWER)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return scratch_path(spark, f"llm/{name}_{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so
    a lost executor later costs only a reread."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hex64(col: Column) -> Column:
    """16 lowercase hex digits of a 64-bit integer."""
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def signed(a: np.ndarray) -> np.ndarray:
    """uint64 values as Spark's signed 64-bit integers (same bits)."""
    return a.astype(np.uint64, copy=False).view(np.int64)


def as_long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def groups(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of each run of equal keys."""
    n = len(keys[0])
    if n:
        new = np.zeros(n - 1, dtype=bool)
        for k in keys:
            new |= k[1:] != k[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), n]
        yield from zip(cuts, cuts[1:])
