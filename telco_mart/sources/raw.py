"""Raw feeds: CSV read as text, with lineage columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telco_mart.schemas import raw_schema


def with_lineage(df: DataFrame, source: str | None = None) -> DataFrame:
    """Add ``_loaded_at`` and ``_source_file`` (file path of each row when the
    frame comes from a file scan, else the given source name)."""
    src = F.lit(source) if source is not None else F.col("_metadata.file_path")
    return df.withColumn("_loaded_at", F.current_timestamp()).withColumn("_source_file", src)


def read_feed(spark: SparkSession, feed: str, path: str, lineage: bool = True) -> DataFrame:
    """Read one raw feed (headered CSV, one file or a folder) with an all-text
    schema; malformed rows are kept (PERMISSIVE) and cleaned downstream."""
    df = (spark.read.schema(raw_schema(feed))
          .option("header", True).option("mode", "PERMISSIVE")
          .option("encoding", "UTF-8").csv(path))
    return with_lineage(df) if lineage else df
