from telco_mart.sources.raw import read_feed, with_lineage  # noqa: F401
from telco_mart.sources.driver_tables import DriverTables, raw_feeds  # noqa: F401
