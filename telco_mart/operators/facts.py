"""Fact loads: surrogate-key resolution, rejects, idempotent appends, upserts.

Lookups are put together at dimension size first: subscriber -> key, country
and current plan; tower -> key and location. A usage load then makes two
fact-wide joins, on ``subscriber_id`` and on ``tower_id``, each in a stage of
its own, so that adaptive execution can split a subscriber or tower that
carries a large share of the events. Duplicates collapse before that, on the
narrow rows, to the largest row per ``usage_id``: the same row whatever the
order in which tasks run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telco_mart.config import WarehouseConfig, DEFAULT_CONFIG
from telco_mart.functions.keys import date_key, surrogate_key
from telco_mart.operators.cleaning import BAD_DATE, BAD_REFERENCE
from telco_mart.operators.dimensions import current
from telco_mart.operators.lookup import sized
from telco_mart.operators.scd import latest_per_key, one_per_key
from telco_mart.schemas import FACT_USAGE, FACT_INCIDENT, conform

GB_PER_MB = "0.0009765625"  # 1/1024, exact in decimal


MISSING_KEY = "clé étrangère introuvable"


def subscriber_plan_lookup(dim_subscriber: DataFrame, dim_plan: DataFrame) -> DataFrame:
    """subscriber_id -> (subscriber_sk, subscriber country, plan_sk of the
    current plan of the subscriber's plan_id; NULL when unresolved)."""
    s = current(dim_subscriber).select("subscriber_id", "subscriber_sk", "plan_id",
                                       F.col("country").alias("sub_country"))
    p = current(dim_plan).select("plan_id", "plan_sk")
    return s.join(p, "plan_id", "left").drop("plan_id")


def plan_point_in_time(usage: DataFrame, dim_subscriber: DataFrame, dim_plan: DataFrame,
                       date_col: str = "event_date") -> DataFrame:
    """Plan version valid at the event date, of the plan that the subscriber
    had then. Subscriber and plan histories are joined first, at dimension
    size, into one list of (from, to, plan_sk) per subscriber (as long as its
    own history); usage then makes a single join on the subscriber."""
    s = dim_subscriber.select("subscriber_id", "plan_id", F.col("date_debut").alias("s_from"), F.col("date_fin").alias("s_to"))
    p = dim_plan.select("plan_id", "plan_sk", F.col("date_debut").alias("p_from"), F.col("date_fin").alias("p_to"))
    start, end = F.greatest("s_from", "p_from"), F.least("s_to", "p_to")  # least/greatest skip open ends
    spans = s.join(p, "plan_id").filter(end.isNull() | (start < end))
    spans = spans.groupBy("subscriber_id").agg(F.collect_list(F.struct(start.alias("a"), end.alias("b"), "plan_sk")).alias("_spans"))
    day = F.col(date_col)
    then = F.filter("_spans", lambda x: (day >= x["a"]) & (x["b"].isNull() | (day < x["b"])))
    return usage.join(spans, "subscriber_id", "left").select(*usage.columns, F.try_element_at(then, F.lit(1))["plan_sk"].alias("plan_sk"))


def subscriber_lookup(dim_subscriber: DataFrame, dim_plan: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per subscriber_id: keys and country, and whether the id is in
    ``known`` (default: the dimension itself)."""
    keys = subscriber_plan_lookup(dim_subscriber, dim_plan)
    if known is None:
        return keys.withColumn("_sub_known", F.lit(True))
    ids = known.select("subscriber_id").distinct().withColumn("_sub_known", F.lit(True))
    return ids.join(keys, "subscriber_id", "full_outer")


def tower_lookup(dim_tower: DataFrame, dim_location: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per tower_id: key, location of the tower's own place, and the
    locations of its city by country (a map bounded by the countries)."""
    t = dim_tower.select("tower_id", "tower_sk", F.col("city").alias("_city"), F.col("country").alias("_country"))
    places = (dim_location.filter("city is not null and country is not null").groupBy(F.col("city").alias("_city"))
              .agg(F.map_from_entries(F.collect_list(F.struct("country", "location_sk"))).alias("_places")))
    out = t.join(places, "_city", "left").select(
        "tower_id", "tower_sk", F.try_element_at("_places", F.col("_country")).alias("_tower_location"), "_places")
    if known is None:
        return out.withColumn("_tower_known", F.lit(True))
    ids = known.select("tower_id").distinct().withColumn("_tower_known", F.lit(True))
    return ids.join(out, "tower_id", "full_outer")


#: Columns that key resolution adds to a usage row.
RESOLVED = ["subscriber_sk", "plan_sk", "tower_sk", "location_sk", "rejection_reason"]


def resolve_usage(usage: DataFrame, dim_subscriber: DataFrame, dim_tower: DataFrame, dim_plan: DataFrame, dim_location: DataFrame,
                  cfg: WarehouseConfig = DEFAULT_CONFIG, subscribers: DataFrame | None = None, towers: DataFrame | None = None,
                  written: bool = False, counted: bool = False) -> DataFrame:
    """One row per usage id with its keys and, where it cannot be loaded, the
    reason: its subscriber or tower is not in ``subscribers`` / ``towers`` (where
    given), its time is missing or outside the valid years, or its subscriber,
    tower or location key cannot be resolved. The plan key may stay NULL.
    ``written``: usage and dimensions are read from tables, so that ids and
    dimension rows can be counted before any row is moved. ``counted``: so can the
    usage ids of a plan over stored feeds, which is then read twice (a stream's
    batch counts as written)."""
    usage = one_per_key(usage, "usage_id") if written or counted else latest_per_key(usage, "usage_id")
    tower = tower_lookup(dim_tower, dim_location, towers)
    if cfg.usage_country_from == "tower":
        tower = tower.drop("_places")
    subscriber = subscriber_lookup(dim_subscriber, dim_plan, subscribers)
    if written:
        subscriber, tower = sized(subscriber), sized(tower)
    j = usage.join(subscriber, "subscriber_id", "left").join(tower, "tower_id", "left")
    location = (F.col("_tower_location") if cfg.usage_country_from == "tower"
                else F.try_element_at("_places", F.col("sub_country")))
    ts = F.col("event_datetime")
    keys_ok = F.col("subscriber_sk").isNotNull() & F.col("tower_sk").isNotNull() & location.isNotNull()
    in_feeds = F.col("_sub_known").isNotNull() & F.col("_tower_known").isNotNull()
    reason = F.when(~keys_ok, F.lit(MISSING_KEY))
    if subscribers is not None or towers is not None:
        valid = F.coalesce(F.year(ts).between(*cfg.valid_years), F.lit(False))
        reason = F.when(~in_feeds, F.lit(BAD_REFERENCE)).when(~valid, F.lit(BAD_DATE)).when(~keys_ok, F.lit(MISSING_KEY))
    return j.withColumns({"location_sk": location, "rejection_reason": reason}).select(*usage.columns, *RESOLVED)


def split_usage(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected) of ``resolve_usage`` rows."""
    rejected = resolved.filter(F.col("rejection_reason").isNotNull()).select(
        *(c for c in resolved.columns if c not in RESOLVED and not c.startswith("_")), "rejection_reason")
    ts, data_mb = F.col("event_datetime"), F.col("data_mb").try_cast("decimal(12,4)")
    loaded = resolved.filter(F.col("rejection_reason").isNull()).withColumns({
        "usage_sk": surrogate_key("usage_id"),
        "date_sk": date_key(ts),
        "event_hour": F.hour(ts),
        "duration_min": (F.col("duration_sec") / F.lit(60.0)).try_cast("decimal(8,2)"),
        "data_mb": data_mb,
        "data_gb": (data_mb * F.lit(GB_PER_MB).cast("decimal(11,10)")).try_cast("decimal(12,6)"),
        "amount_fcfa": F.col("amount_fcfa").try_cast("decimal(12,2)"),
        "annee": F.year(ts),
    })
    return conform(loaded, FACT_USAGE), rejected


def load_fact_usage(usage: DataFrame, *lookups, **options) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected) of usage rows in one plan: ``resolve_usage``, split."""
    return split_usage(resolve_usage(usage, *lookups, **options))


def load_fact_incident(incidents: DataFrame, dim_tower: DataFrame, dim_location: DataFrame, calendar: DataFrame | None = None,
                       description_width: int | None = None, counted: bool = False) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected): rejected when tower, location or day cannot be
    resolved; a day must be in ``calendar`` where one is given (a broadcast
    bounded by its days). ``description_width`` cuts the description for a
    store with a column width; by default it is kept whole. ``counted``: as in
    ``resolve_usage``, of the incident ids."""
    incidents = one_per_key(incidents, "incident_id") if counted else latest_per_key(incidents, "incident_id")
    j = incidents.join(tower_lookup(dim_tower, dim_location), "tower_id", "left").withColumn("location_sk", F.col("_tower_location"))
    ts = F.col("incident_datetime")
    j = j.withColumn("date_sk", date_key(ts))
    if calendar is not None:
        days = F.broadcast(calendar.select(F.col("date_sk").alias("_day")))
        j = j.join(days, F.col("date_sk") == F.col("_day"), "left")
    else:
        j = j.withColumn("_day", F.col("date_sk"))
    ok = F.col("tower_sk").isNotNull() & F.col("location_sk").isNotNull() & F.col("_day").isNotNull()
    rejected = j.filter(~ok).select(*incidents.columns, F.lit("clé manquante").alias("rejection_reason"))
    text = F.col("description") if description_width is None else F.substring("description", 1, description_width)
    loaded = j.filter(ok).withColumns({"incident_sk": surrogate_key("incident_id"), "description": text, "annee": F.year(ts)})
    return conform(loaded, FACT_INCIDENT), rejected


def append_new(target: DataFrame, batch: DataFrame, key: str | list[str], years: str | None = None, written: bool = False) -> DataFrame:
    """Rows of ``batch`` to append so that ``key`` stays unique in the target:
    duplicates inside the batch collapse to the largest row, keys already
    present are skipped. ``years`` names the target's partition column where
    equal keys have equal years and ``batch`` has one row per key: then only ids
    of the years that the batch has are read (partition pruning at run time).
    ``written``: the batch is read from a table, so that only its rows whose key
    repeats are grouped."""
    keys = [key] if isinstance(key, str) else list(key)
    if years is None and written and len(keys) == 1:
        return one_per_key(batch, keys[0]).join(target.select(*keys), keys, "left_anti")
    if years is None:
        return largest_per_key(batch, keys).join(target.select(*keys), keys, "left_anti")
    held = target.join(F.broadcast(batch.select(years).distinct()), years, "left_semi")  # one row a year
    return batch.join(held.select(years, *keys), [years, *keys], "left_anti")


def largest_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    row = df.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_r"))
    return row.select(*keys, "_r.*").select(*df.columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed upsert: source rows replace target rows with the same keys."""
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)
