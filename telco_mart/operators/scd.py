"""Slowly changing dimensions as set-based merges.

Plain Parquet has no MERGE, so each merge returns the full new state of the
dimension; writing it to a new version folder is the caller's job
(``operators.export.materialize``). One full-outer join on the natural key
between the incoming snapshot and the *current* rows classifies every key;
history rows (``is_current = 0``) bypass the join entirely.

Change tests are null-safe (``<=>``), so NULL -> value and value -> NULL are
changes and NULL -> NULL is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telco_mart.functions.keys import surrogate_key
from telco_mart.operators.lookup import join_lookup
from telco_mart.session import checkpoint_dir

SCD2_COLS = ["date_debut", "date_fin", "is_current", "version"]
#: Type of the change feed of a merged row.
CHANGES = "array<struct<column_name:string,old_value:string,new_value:string>>"
FEED = {"_kind": "string", "_changes": CHANGES}


def _differs(cols: list[str]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | ~F.col(f"i.{c}").eqNullSafe(F.col(f"c.{c}"))
    return out


def latest_per_key(incoming: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """Keep one row per key: the last by ``order_by``, ties broken by every
    other column, so the choice is deterministic. A ``max`` of the row itself
    (combined map-side), so a key repeated on a third of the rows never
    lands whole in one task; its hash partitioning on the key is reused by
    the merge join that follows."""
    order_by = [c for c in order_by or [] if c != key]
    others = [c for c in incoming.columns if c != key]
    rank = F.struct(*[F.col(c) for c in order_by + [c for c in others if c not in order_by]])
    return (incoming.groupBy(key).agg(F.max(rank).alias("_r"))
            .select(key, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*incoming.columns))


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """``latest_per_key`` of a table, or of a plan that gives the same rows each
    time, whose keys seldom repeat: hashes of the keys are counted first, and only
    rows whose hash occurs more than once are grouped. The others, all of them where
    nothing repeats, are not moved. The key alone is computed for the count."""
    checkpoint_dir(df.sparkSession)
    hashes = df.select(F.xxhash64(key).alias("_hash"))
    repeated = hashes.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash", F.lit(True).alias("_again")).checkpoint()
    if repeated.isEmpty():
        return df
    found = join_lookup(df.withColumn("_hash", F.xxhash64(key)), repeated, ["_hash"])
    again = found.filter("_again").select(*df.columns)
    return found.filter("_again is null").select(*df.columns).unionByName(latest_per_key(again, key))


def classify_changes(current: DataFrame, incoming: DataFrame, key: str, tracked: list[str],
                     type1: list[str] | None = None) -> DataFrame:
    """Incoming rows with ``change_type`` in new / changed / minor / same."""
    type1 = type1 or []
    cur = current.filter(F.col("is_current") == 1)
    j = incoming.alias("i").join(cur.alias("c"), F.col(f"i.{key}") == F.col(f"c.{key}"), "left")
    ct = (F.when(F.col(f"c.{key}").isNull(), F.lit("new"))
          .when(_differs(tracked), F.lit("changed"))
          .when(_differs(type1), F.lit("minor"))
          .otherwise(F.lit("same")))
    return j.select(*[F.col(f"i.{c}") for c in incoming.columns], ct.alias("change_type"))


def scd2_merge(current: DataFrame, incoming: DataFrame, key: str, tracked: list[str],
               type1: list[str] | None = None, as_of: str = "", sk_col: str | None = None,
               protected: DataFrame | None = None, protected_cols: dict | None = None,
               skip_unchanged: bool = False, order_by: list[str] | None = None, changes: bool = False) -> DataFrame:
    """Type-2 merge of ``incoming`` into ``current``. Several incoming rows of
    one key collapse to the last by ``order_by`` (``latest_per_key``).

    * key absent from the dimension -> version 1, current from ``as_of``;
    * a tracked column differs -> the current version is closed
      (``is_current = 0``, ``date_fin = as_of``) and version + 1 is opened
      with the incoming values;
    * only Type-1 columns differ -> overwritten in place on the current row;
    * otherwise, or key absent from ``incoming`` -> unchanged.

    ``protected``/``protected_cols``: keys whose columns are forced to fixed
    values on every version written (erasure that a later merge must not undo).
    ``skip_unchanged=True`` reproduces an incremental load that skips keys whose
    tracked columns did not change, so Type-1 columns are not refreshed.
    ``changes=True`` adds what the merge did, out of the same join: ``_kind`` (new,
    changed or minor) on the row that holds a key's new state, and ``_changes``,
    its changed columns with old and new value as texts (``CHANGES``).
    """
    type1 = type1 or []
    incoming = latest_per_key(incoming, key, order_by)
    attrs = [c for c in incoming.columns]
    as_of_d = F.lit(as_of).cast("date")
    hist = current.filter(F.col("is_current") != 1)
    cur = current.filter(F.col("is_current") == 1)
    out_cols = [c for c in current.columns]

    j = incoming.alias("i").join(cur.alias("c"), F.col(f"i.{key}") == F.col(f"c.{key}"), "full_outer")
    in_i = F.col(f"i.{key}").isNotNull()
    in_c = F.col(f"c.{key}").isNotNull()
    changed = in_i & in_c & _differs(tracked)
    minor = in_i & in_c & ~_differs(tracked) & _differs(type1) & F.lit(not skip_unchanged)
    j = j.withColumn("_kind", F.when(~in_c, F.lit("new")).when(changed, F.lit("changed"))
                     .when(minor, F.lit("minor")).when(in_c & ~in_i, F.lit("absent"))
                     .otherwise(F.lit("same")))

    def from_current(overrides: dict) -> list:
        return [overrides.get(c, F.col(f"c.{c}")).alias(c) for c in out_cols]

    def from_incoming(version: Column) -> list:
        vals = {c: F.col(f"i.{c}") for c in attrs}
        vals.update({"date_debut": as_of_d, "date_fin": F.lit(None).cast("date"),
                     "is_current": F.lit(1), "version": version})
        return [vals.get(c, F.lit(None)).cast(current.schema[c].dataType).alias(c) for c in out_cols]

    # one or two versions per joined row, from a single pass over the join
    text = lambda col, c: col.cast(current.schema[c].dataType).cast("string")
    differing = [F.when(~F.col(f"i.{c}").cast(current.schema[c].dataType).eqNullSafe(F.col(f"c.{c}")), F.struct(
        F.lit(c).alias("column_name"), text(F.col(f"c.{c}"), c).alias("old_value"), text(F.col(f"i.{c}"), c).alias("new_value"))) for c in (*tracked, *type1)]
    made = F.array_compact(F.array(*differing)) if changes and differing else F.array()
    feed = lambda fresh: [
        F.when(F.lit(fresh) & F.col("_kind").isin("new", "changed", "minor"), F.col("_kind")).alias("_kind"),
        F.when(F.lit(fresh) & F.col("_kind").isin("changed", "minor"), made.cast(CHANGES)).otherwise(F.array().cast(CHANGES)).alias("_changes"),
    ] if changes else []
    version = lambda cols, fresh=False: F.struct(*[c.cast(current.schema[n].dataType).alias(n) for n, c in zip(out_cols, cols)], *feed(fresh))
    kept = version(from_current({}))
    closed = version(from_current({"is_current": F.lit(0), "date_fin": as_of_d}))
    opened = version(from_incoming(F.coalesce(F.col("c.version") + 1, F.lit(1))), True)
    updated = version(from_current({c: F.col(f"i.{c}") for c in type1}), True)
    versions = (F.when(F.col("_kind") == "new", F.array(opened)).when(F.col("_kind") == "changed", F.array(closed, opened))
                .when(F.col("_kind") == "minor", F.array(updated)).otherwise(F.array(kept)))
    merged = j.select(F.inline(versions))
    extra = {"_kind": F.lit(None).cast("string"), "_changes": F.array().cast(CHANGES)} if changes else {}
    out = hist.select(*out_cols).withColumns(extra) if extra else hist.select(*out_cols)
    out = out.unionByName(merged.select(*out_cols, *extra))
    if protected is not None and protected_cols:
        p = protected.select(F.col(key).alias("_pk")).distinct().withColumn("_protected", F.lit(True))
        out = out.join(p, out[key] == p["_pk"], "left").drop("_pk")
        out = out.withColumns({c: F.when(F.col("_protected"), F.lit(v).cast(current.schema[c].dataType))
                               .otherwise(F.col(c)) for c, v in protected_cols.items()}).drop("_protected")
    if sk_col:
        out = out.withColumn(sk_col, surrogate_key(key, "version"))
    return out.select(*out_cols, *extra)


def scd2_initial(incoming: DataFrame, key: str, as_of: str, sk_col: str) -> DataFrame:
    """First load: one row per key (``latest_per_key``), version 1, current
    from ``as_of``."""
    incoming = latest_per_key(incoming, key)
    return incoming.select(
        surrogate_key(key, F.lit(1)).alias(sk_col), *incoming.columns,
        F.lit(as_of).cast("date").alias("date_debut"), F.lit(None).cast("date").alias("date_fin"),
        F.lit(1).alias("is_current"), F.lit(1).alias("version"))


def scd1_merge(current: DataFrame, incoming: DataFrame, key: str, keep_cols: list[str],
               sk_col: str | None = None) -> DataFrame:
    """Type-1 merge: insert new keys, overwrite existing rows with the incoming
    values except ``keep_cols`` (kept from the existing row), keep absent keys.
    Several incoming rows of one key collapse first (``latest_per_key``)."""
    incoming = latest_per_key(incoming, key)
    cols = [c for c in current.columns]
    j = incoming.alias("i").join(current.alias("c"), F.col(f"i.{key}") == F.col(f"c.{key}"), "full_outer")
    in_i = F.col(f"i.{key}").isNotNull()
    in_c = F.col(f"c.{key}").isNotNull()
    sel = []
    for c in cols:
        if c == sk_col:
            sel.append(F.coalesce(F.col(f"c.{c}"), surrogate_key(F.col(f"i.{key}"))).alias(c))
        elif c in keep_cols or c not in incoming.columns:
            sel.append(F.when(in_c, F.col(f"c.{c}")).otherwise(
                F.col(f"i.{c}") if c in incoming.columns else F.lit(None)).cast(current.schema[c].dataType).alias(c))
        else:
            sel.append(F.when(in_i, F.col(f"i.{c}")).otherwise(F.col(f"c.{c}"))
                       .cast(current.schema[c].dataType).alias(c))
    return j.select(*sel)
