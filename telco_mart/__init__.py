"""telco_mart: a PySpark-native telecom customer and network analytics warehouse.

Every public function is DataFrame-in, DataFrame-out and built from built-in
Spark expressions, so Catalyst can prune, push down and plan the joins.

Sub-packages
------------
sources     readers for raw feeds and the driver-table adapter
functions   column-level expressions (cleaning, calendar, keys)
operators   table-level operators (quality, SCD, facts, marts, roll-ups, ...)
plans       warehouse assembly and the registered query catalogue
streaming   incremental ingest with Structured Streaming
"""

from telco_mart.config import WarehouseConfig, DEFAULT_CONFIG  # noqa: F401
from telco_mart.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["WarehouseConfig", "DEFAULT_CONFIG", "get_spark", "checkpoint_dir"]
