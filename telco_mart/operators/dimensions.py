"""Dimension builders: plan (SCD2), tower (SCD1), subscriber (SCD2), location,
current-version views and the guarded delete."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telco_mart import config as C
from telco_mart.config import WarehouseConfig, DEFAULT_CONFIG
from telco_mart.functions import cleaning as X
from telco_mart.functions.keys import surrogate_key
from telco_mart.operators.scd import CHANGES, FEED, latest_per_key, scd2_initial, scd2_merge, scd1_merge
from telco_mart.schemas import DIM_PLAN, DIM_TOWER, DIM_SUBSCRIBER, DIM_LOCATION, conform

SUBSCRIBER_TRACKED = ["city", "segment", "plan_id"]
SUBSCRIBER_TYPE1 = ["churn", "churn_date", "monthly_revenue", "phone_number", "email"]
PLAN_TRACKED = ["monthly_fee"]
TOWER_KEEP = ["installation_date"]


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current") == 1)


def whole_months(start, end) -> F.Column:
    """Completed calendar months from ``start`` to ``end`` (a month completes
    on the same day-of-month)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))
            - F.when(F.dayofmonth(e) < F.dayofmonth(s), 1).otherwise(0))


def _subscriber_attrs(subs: DataFrame, as_of: str, tenure: bool = True) -> DataFrame:
    """Derived subscriber columns: full name and tenure in whole months
    (``tenure=False``: left NULL, as the original never fills it)."""
    end = F.coalesce(F.col("churn_date"), F.lit(as_of).cast("date"))
    t = whole_months(F.col("subscription_date"), end) if tenure else F.lit(None)
    return subs.withColumns({
        "nom_complet": F.concat_ws(" ", "first_name", "last_name"),
        "anciennete_mois": t.cast("int"),
    })


def _first(dim: DataFrame, schema: dict, changes: bool) -> DataFrame:
    """A first load on its schema; with a change feed, all rows are new."""
    out = conform(dim, schema)
    return out.withColumns({"_kind": F.lit("new"), "_changes": F.array().cast(CHANGES)}) if changes else out


def build_dim_plan(plans: DataFrame, as_of: str, existing: DataFrame | None = None, changes: bool = False) -> DataFrame:
    """``changes=True`` adds the change feed of ``scd2_merge``."""
    if existing is None:
        return _first(scd2_initial(plans, "plan_id", as_of, "plan_sk"), DIM_PLAN, changes)
    inc = plans.select(*[c for c in DIM_PLAN if c in plans.columns])
    out = scd2_merge(existing, inc, "plan_id", PLAN_TRACKED, [], as_of, "plan_sk", changes=changes)
    return conform(out, {**DIM_PLAN, **(FEED if changes else {})})


def build_dim_subscriber(subs: DataFrame, as_of: str, existing: DataFrame | None = None,
                         erased: DataFrame | None = None, tenure: bool = True,
                         skip_unchanged: bool = False, changes: bool = False) -> DataFrame:
    """``changes=True`` adds the change feed of ``scd2_merge``."""
    subs = _subscriber_attrs(subs, as_of, tenure)
    inc = subs.select(*[c for c in DIM_SUBSCRIBER if c in subs.columns and c not in
                        ("subscriber_sk", "date_debut", "date_fin", "is_current", "version")])
    if existing is None:
        return _first(scd2_initial(inc, "subscriber_id", as_of, "subscriber_sk"), DIM_SUBSCRIBER, changes)
    erased_cols = None
    if erased is not None:
        erased_cols = {"first_name": C.ANONYMISED, "last_name": C.ANONYMISED,
                       "nom_complet": C.ANONYMISED + " " + C.ANONYMISED,
                       "phone_number": None, "email": None}
    out = scd2_merge(existing, inc, "subscriber_id", SUBSCRIBER_TRACKED, SUBSCRIBER_TYPE1, as_of,
                     "subscriber_sk", protected=erased, protected_cols=erased_cols,
                     skip_unchanged=skip_unchanged, changes=changes)
    return conform(out, {**DIM_SUBSCRIBER, **(FEED if changes else {})})


def build_dim_tower(towers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    t = latest_per_key(towers.select(*[c for c in DIM_TOWER if c in towers.columns]), "tower_id")
    t = conform(t.withColumn("tower_sk", surrogate_key("tower_id")), DIM_TOWER)
    if existing is None:
        return t
    return conform(scd1_merge(existing, t.drop("tower_sk"), "tower_id", TOWER_KEEP, "tower_sk"), DIM_TOWER)


def build_dim_location(towers: DataFrame, cfg: WarehouseConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per (city, country) of the towers; region, coordinates and zone
    come from the tower with the smallest tower_id of that place."""
    first = (towers.groupBy("city", "country")
             .agg(F.min_by(F.struct("region", "latitude", "longitude", "zone_type"), F.col("tower_id")).alias("t"))
             .select("city", "country", "t.*"))
    return conform(first.withColumns({
        "location_sk": surrogate_key("city", "country"),
        "continent": F.lit(C.DEFAULT_CONTINENT),
        "population_zone": X.population_zone("city", cfg.large_cities, cfg.medium_cities),
        "fuseau_horaire": X.timezone("country"),
    }), DIM_LOCATION)


def guarded_delete(dim: DataFrame, to_delete: DataFrame, key: str, fact: DataFrame,
                   dim_sk: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Delete the dimension rows of the keys in ``to_delete`` unless a fact row
    references any version of them. Returns (remaining, refused, deleted)."""
    ids = to_delete.select(key).distinct()
    targets = dim.join(ids, key, "left_semi")
    # the fact is first cut to the requested keys
    referenced_sk = fact.select(F.col(dim_sk)).join(targets.select(dim_sk), dim_sk, "left_semi").distinct()
    ref_keys = targets.join(referenced_sk, dim_sk, "left_semi").select(key).distinct()
    refused = ids.join(ref_keys, key, "left_semi")
    deletable = ids.join(ref_keys, key, "left_anti")
    deleted = dim.join(deletable, key, "left_semi")
    remaining = dim.join(deletable, key, "left_anti")
    return remaining, refused, deleted
