"""Materialisation and export of warehouse tables.

``materialize`` never overwrites a folder that a running plan may read: each
refresh writes a new version folder under the table root and then records it
in ``_CURRENT`` (a one-line pointer file). Readers resolve the pointer.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _hadoop_fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    line = reader.readLine()
    reader.close()
    return line


def materialize(df: DataFrame, root: str, partition_by: list[str] | None = None,
                fmt: str = "parquet") -> str:
    """Write ``df`` as a new version of the table at ``root`` and point
    ``root/_CURRENT`` at it. Returns the version path."""
    spark = df.sparkSession
    version = f"version_{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}"
    path = f"{root.rstrip('/')}/{version}"
    w = df.write.mode("error").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    _write_text(spark, f"{root.rstrip('/')}/_CURRENT", version)
    return path


def read_current(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    version = _read_text(spark, f"{root.rstrip('/')}/_CURRENT")
    if version is None:
        raise FileNotFoundError(f"no materialised version under {root}")
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{version}")


def modified(spark: SparkSession, path: str) -> int:
    """Time of the last change of a file or folder (milliseconds)."""
    fs, p, _ = _hadoop_fs(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _hadoop_fs(spark, path)
    return fs.exists(p)


def export_tables(tables: dict[str, DataFrame], out_root: str, fmt: str = "parquet",
                  single_file: bool = False) -> DataFrame:
    """Portable extract of small tables (KPI marts): one folder per table,
    replaced on each export; failures are isolated per table. ``single_file``
    gathers a table in one file (one task): only for tables known to be small.
    Returns a summary frame (table, rows, status, path)."""
    spark = None
    rows = []
    for name, df in tables.items():
        spark = df.sparkSession
        path = f"{out_root.rstrip('/')}/{name}"
        try:
            out = df.coalesce(1) if single_file else df
            w = out.write.mode("overwrite").format(fmt)
            if fmt == "csv":
                w = w.option("header", True)
            w.save(path)
            n = spark.read.format(fmt).option("header", True).load(path).count()
            rows.append((name, int(n), "OK", path))
        except Exception as e:  # noqa: BLE001 - isolate per table
            rows.append((name, 0, f"ERROR: {type(e).__name__}", path))
    return spark.createDataFrame(rows, "table_name string, rows long, status string, path string")
