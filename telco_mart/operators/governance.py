"""Governance: change audit, erasure, run summary.

The audit compares the current rows of a dimension before and after a merge
(one equi-join on the natural key), so every change is logged whatever path
produced it, and unpivots the changed columns into audit rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telco_mart import config as C
from telco_mart.operators.dimensions import current
from telco_mart.schemas import AUDIT_LOG, conform


def audit_diff(before: DataFrame, after: DataFrame, table: str, key: str,
               columns: dict[str, bool], only_current: bool = True) -> DataFrame:
    """Audit rows (table, UPDATE, key, column, old, new) for every key whose
    ``columns`` differ between ``before`` and ``after``, plus DELETE rows for
    keys that disappeared. ``columns`` maps a column to True for a null-safe
    comparison, False for a plain ``<>`` (NULL on either side is no change)."""
    b = current(before) if only_current else before
    a = current(after) if only_current else after
    cols = list(columns)
    j = (b.select(key, *[F.col(c).alias(f"o_{c}") for c in cols], F.lit(True).alias("_b"))
         .join(a.select(key, *[F.col(c).alias(f"n_{c}") for c in cols], F.lit(True).alias("_a")),
               key, "full_outer")
         .withColumns({"_in_b": F.coalesce("_b", F.lit(False)), "_in_a": F.coalesce("_a", F.lit(False))}))
    entries = []
    for c, null_safe in columns.items():
        o, n = F.col(f"o_{c}"), F.col(f"n_{c}")
        diff = ~o.eqNullSafe(n) if null_safe else F.coalesce(o != n, F.lit(False))
        entries.append(F.when(diff, F.struct(
            F.lit(c).alias("column_name"), o.cast("string").alias("old_value"),
            n.cast("string").alias("new_value"))))
    both = j.filter(F.col("_in_b") & F.col("_in_a"))
    updates = (both.select(key, F.explode(F.array_compact(F.array(*entries))).alias("e"))
               .select(F.lit(table).alias("table_name"), F.lit("UPDATE").alias("operation"),
                       F.col(key).cast("string").alias("record_pk"), "e.*"))
    deletes = j.filter(F.col("_in_b") & ~F.col("_in_a")).select(
        F.lit(table).alias("table_name"), F.lit("DELETE").alias("operation"),
        F.col(key).cast("string").alias("record_pk"), F.lit(None).cast("string").alias("column_name"),
        F.lit(None).cast("string").alias("old_value"), F.lit(None).cast("string").alias("new_value"))
    return updates.unionByName(deletes).withColumns(
        {"changed_by": F.expr("current_user()"), "changed_at": F.current_timestamp()})


def audit_changes(merged: DataFrame, table: str, key: str, columns: dict[str, bool]) -> DataFrame:
    """The UPDATE rows of ``audit_diff`` out of a merge's own change feed
    (``scd2_merge(changes=True)``): no comparison of the two states. ``columns``
    as there: False leaves out changes from or to NULL."""
    rows = merged.filter(F.size("_changes") > 0).select(F.col(key).cast("string").alias("record_pk"), F.explode("_changes").alias("e"))
    plain = [c for c, null_safe in columns.items() if not null_safe]
    wanted = F.col("e.column_name").isin(list(columns)) & (~F.col("e.column_name").isin(plain) | (F.col("e.old_value").isNotNull() & F.col("e.new_value").isNotNull()))
    out = rows.filter(wanted).select(F.lit(table).alias("table_name"), F.lit("UPDATE").alias("operation"), "record_pk", "e.*",
                                     F.expr("current_user()").alias("changed_by"), F.current_timestamp().alias("changed_at"))
    return conform(out, AUDIT_LOG)


def pseudonymise(dim_subscriber: DataFrame, ids: DataFrame, key: str = "subscriber_id"
                 ) -> tuple[DataFrame, DataFrame]:
    """Erase identifying columns on ALL versions of the given ids. Returns the
    new dimension and one audit row per erased id. ``ids`` is a set of keys
    (a request list): joined by key, never collected."""
    req = ids.select(key).distinct().withColumn("_erase", F.lit(True))
    d = dim_subscriber.join(req, key, "left")
    e = F.coalesce(F.col("_erase"), F.lit(False))
    out = d.withColumns({
        "first_name": F.when(e, F.lit(C.ANONYMISED)).otherwise(F.col("first_name")),
        "last_name": F.when(e, F.lit(C.ANONYMISED)).otherwise(F.col("last_name")),
        "nom_complet": F.when(e, F.lit(f"{C.ANONYMISED} {C.ANONYMISED}")).otherwise(F.col("nom_complet")),
        "phone_number": F.when(e, F.lit(None).cast("string")).otherwise(F.col("phone_number")),
        "email": F.when(e, F.lit(None).cast("string")).otherwise(F.col("email")),
    }).drop("_erase").select(*dim_subscriber.columns)
    audit = dim_subscriber.join(req.drop("_erase"), key, "left_semi").select(key).distinct().select(
        F.lit("dim_subscriber").alias("table_name"), F.lit("UPDATE").alias("operation"),
        F.col(key).cast("string").alias("record_pk"),
        *(F.lit(text).alias(name) for name, text in C.ERASURE.items()),
        F.expr("current_user()").alias("changed_by"), F.current_timestamp().alias("changed_at"))
    return out, conform(audit, AUDIT_LOG)


def run_summary(log: DataFrame, since_ts=None) -> DataFrame:
    """Run log rows started at or after ``since_ts``, newest first."""
    out = log if since_ts is None else log.filter(F.col("start_time") >= F.lit(since_ts))
    return out.orderBy(F.col("start_time").desc())
