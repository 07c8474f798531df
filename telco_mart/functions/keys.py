"""Keys: deterministic surrogate keys and date keys.

Surrogate keys are 64-bit hashes of the natural key (and version): stable
across re-runs and computed inside each task, with no global sort and no
driver-side counter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols) -> Column:
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def date_key(ts) -> Column:
    """YYYYMMDD integer of a date/timestamp (arithmetic, no string round-trip)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def month_key(ts) -> Column:
    """YYYYMM integer."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.year(ts) * 100 + F.month(ts)


def month_label(ts) -> Column:
    """'YYYY-MM' text, ordered as text like the month key."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, "yyyy-MM")


def date_from_key(date_sk) -> Column:
    k = F.col(date_sk) if isinstance(date_sk, str) else date_sk
    return F.make_date((k / 10000).cast("int"), ((k / 100) % 100).cast("int"), (k % 100).cast("int"))
