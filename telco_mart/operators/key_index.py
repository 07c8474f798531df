"""An index of a table's ids, bucketed by the id, for appends of new rows only.

The ids that a table holds are kept apart from it, hashed into a fixed number of
sorted buckets that Spark knows of (a bucketed table in the catalog). Asking
which rows of a batch are new then shuffles the batch into those buckets and
nothing else: the index is read where it lies, whatever its size, and the
table's history is not read at all.

Ids carry the run that added them. Only ids of the runs that the caller names
count, so the index may be ahead of a table whose run never committed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyIndex:
    """Ids of type text below ``path``, a shared folder. The catalog entry is
    made again in each application; the folder is the index."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.table = f"ids_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}"
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.table} (id STRING, run STRING) USING parquet
                      CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS LOCATION '{self.path}'""")

    def ids(self, runs: list[str] | None = None) -> DataFrame:
        """(id) of all runs, or of those named."""
        rows = self.spark.table(self.table)
        return (rows if runs is None else rows.filter(F.col("run").isin(runs))).select("id")

    def new_rows(self, batch: DataFrame, key: str, runs: list[str] | None = None) -> DataFrame:
        """Rows of ``batch`` whose ``key`` the index does not hold; null keys are new."""
        held = self.ids(runs).hint("merge")  # sorted buckets: merged in place, never gathered
        return batch.join(held, batch[key] == held["id"], "left_anti")

    def add(self, rows: DataFrame, key: str, run: str) -> None:
        """Add the ids of appended rows, each bucket written by one task."""
        ids = rows.select(F.col(key).alias("id"), F.lit(run).alias("run")).filter("id is not null")
        ids.repartition(self.buckets, "id").write.mode("append").insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
