"""Table-level cleaning of the five raw feeds (bronze -> silver).

Each function takes the raw text frame and returns typed columns. Where the
original process rejects rows, the function returns ``(kept, rejected)``;
rejected rows carry a ``rejection_reason``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telco_mart import config as C
from telco_mart.config import WarehouseConfig, DEFAULT_CONFIG
from telco_mart.functions import cleaning as X
from telco_mart.operators.lookup import join_lookup
from telco_mart.operators.median import group_medians


BAD_REFERENCE, BAD_DATE = "référence abonné/antenne invalide", "date invalide"


def split_valid(df: DataFrame, ok: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """Split on a predicate; NULL counts as not valid."""
    flag = F.coalesce(ok, F.lit(False))
    return df.filter(flag), df.filter(~flag).withColumn("rejection_reason", F.lit(reason))


def clean_plans(raw: DataFrame, cfg: WarehouseConfig = DEFAULT_CONFIG) -> DataFrame:
    fee = X.to_number("monthly_fee")
    return raw.select(
        "plan_id", "plan_name", "country",
        fee.try_cast("decimal(10,2)").alias("monthly_fee"),
        X.to_number("data_quota_gb").try_cast("decimal(8,2)").alias("data_quota_gb"),
        X.to_int("call_minutes").alias("call_minutes"),
        X.to_int("sms_quota").alias("sms_quota"),
        F.col("type").alias("type_abonnement"),
        X.price_category(fee, "country", cfg.price_bands, cfg.default_price_band).alias("categorie_prix"),
    )


def clean_towers(raw: DataFrame, cfg: WarehouseConfig = DEFAULT_CONFIG) -> DataFrame:
    return raw.select(
        "tower_id", "tower_name", "city", "region", "country",
        X.to_number("latitude").alias("latitude"),
        X.to_number("longitude").alias("longitude"),
        X.to_int("capacity_users", fill=0).alias("capacity_users"),
        "technology",
        X.to_date("installation_date").alias("installation_date"),
        X.fill_text(F.trim("status"), C.UNKNOWN).alias("status"),
        X.fill_text("etat_batterie", C.NOT_PROVIDED).alias("etat_batterie"),
        X.zone_type("city", cfg.urban_cities).alias("zone_type"),
    )


def clean_subscribers(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed subscribers; revenue gaps take the median of the whole feed,
    computed before rows without subscriber_id or plan_id are rejected."""
    age = X.valid_age("age")
    rev = X.to_number("monthly_revenue")
    typed = raw.select(
        X.blank_to_null("subscriber_id").alias("subscriber_id"), "first_name", "last_name",
        X.clean_gender("gender").alias("gender"),
        age.alias("age"),
        X.age_band(age).alias("tranche_age"),
        "city", "country", X.blank_to_null("plan_id").alias("plan_id"), "tower_id",
        X.to_date("subscription_date").alias("subscription_date"),
        "phone_number", "email",
        X.to_int("churn", fill=0).alias("churn"),
        X.to_date("churn_date").alias("churn_date"),
        rev.alias("monthly_revenue"),
        "segment",
    )
    typed = impute_global_median(typed, "monthly_revenue").withColumn(
        "monthly_revenue", F.col("monthly_revenue").try_cast("decimal(10,2)"))
    return split_valid(typed, F.col("subscriber_id").isNotNull() & F.col("plan_id").isNotNull(),
                       "subscriber_id ou plan_id manquant")


def impute_global_median(df: DataFrame, value: str) -> DataFrame:
    """Fill NULL ``value`` with the exact median of the whole column (one
    value, computed by distributed range refinement, then used as a
    constant)."""
    med = group_medians(df, value).select("median").first()
    fill = F.lit(None if med is None else med[0]).cast("double")
    return df.withColumn(value, F.coalesce(F.col(value), fill))


def impute_group_median(df: DataFrame, value: str, group: str) -> DataFrame:
    """Fill NULL ``value`` with the exact median of its ``group``; a NULL group
    or a group without any value stays NULL. The per-group medians (one row
    per group) are joined back as a size-checked lookup, so rows are not
    shuffled by the group.

    The medians come from ``group_medians``: a hot group (one event type may
    hold a third of the fact) is resolved by counts combined map-side, never
    by gathering its values in one task."""
    return fill_from_medians(df, value, group, group_medians(df, value, group))


def fill_from_medians(df: DataFrame, value: str, group: str, medians: DataFrame) -> DataFrame:
    """Fill NULL ``value`` from a (group, median) table, e.g. a stored one."""
    joined = join_lookup(df, medians.select(group, F.col("median").alias("_grp_median")), [group])
    return joined.withColumn(value, F.coalesce(F.col(value), F.col("_grp_median"))).drop("_grp_median")


#: Columns of a typed usage row.
USAGE_COLUMNS = ["usage_id", "subscriber_id", "tower_id", "event_type", "event_datetime", "duration_sec", "data_mb", "amount_fcfa", "status", "network_type", "roaming"]


def type_usage(raw: DataFrame) -> DataFrame:
    return raw.select(
        "usage_id", "subscriber_id", "tower_id", "event_type",
        X.to_timestamp("event_datetime").alias("event_datetime"),
        X.to_int("duration_sec", fill=0).alias("duration_sec"),
        F.coalesce(X.to_number("data_mb"), F.lit(0.0)).alias("data_mb"),
        X.to_number("amount_fcfa").alias("amount_fcfa"),
        "status", "network_type",
        X.to_int("roaming", fill=0).alias("roaming"),
    )


def typed_usage(raw: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Typed usage, amount gaps filled by the event-type median: of this feed
    (before any row is rejected), or a stored (event_type, median) table."""
    typed = type_usage(raw)
    if medians is None:
        return impute_group_median(typed, "amount_fcfa", "event_type")
    return fill_from_medians(typed, "amount_fcfa", "event_type", medians)


def clean_usage(raw: DataFrame, subscribers: DataFrame, towers: DataFrame, medians: DataFrame | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """``typed_usage`` kept only when the subscriber and the tower exist and
    the event time parses."""
    return whitelist_usage(typed_usage(raw, medians), subscribers, towers)


def whitelist_usage(typed: DataFrame, subscribers: DataFrame, towers: DataFrame) -> tuple[DataFrame, DataFrame]:
    subs = subscribers.select("subscriber_id").distinct()
    tw = towers.select("tower_id").distinct()
    known = (typed.join(subs.withColumn("_sub_ok", F.lit(True)), "subscriber_id", "left")
             .join(tw.withColumn("_tw_ok", F.lit(True)), "tower_id", "left"))
    ok_ref = F.col("_sub_ok").isNotNull() & F.col("_tw_ok").isNotNull()
    ok = ok_ref & F.col("event_datetime").isNotNull()
    reason = F.when(~ok_ref, F.lit(BAD_REFERENCE)).otherwise(F.lit(BAD_DATE))
    cols = typed.columns
    kept = known.filter(F.coalesce(ok, F.lit(False))).select(*cols)
    rejected = (known.filter(~F.coalesce(ok, F.lit(False)))
                .select(*cols, reason.alias("rejection_reason")))
    return kept, rejected


def clean_incidents(raw: DataFrame, towers: DataFrame) -> tuple[DataFrame, DataFrame]:
    typed = raw.select(
        "incident_id", "tower_id", "incident_type", "severity",
        X.to_timestamp("incident_datetime").alias("incident_datetime"),
        X.to_number("resolution_minutes").try_cast("int").alias("resolution_minutes"),
        X.parse_flag("resolved").alias("resolved"),
        X.to_int("nb_abonnes_affectes", fill=0).alias("nb_abonnes_affectes"),
        X.fill_text("description", C.NOT_PROVIDED).alias("description"),
    )
    tw = towers.select("tower_id").distinct().withColumn("_tw_ok", F.lit(True))
    j = typed.join(tw, "tower_id", "left")
    ok = F.col("_tw_ok").isNotNull() & F.col("incident_datetime").isNotNull()
    cols = typed.columns
    return (j.filter(F.coalesce(ok, F.lit(False))).select(*cols),
            j.filter(~F.coalesce(ok, F.lit(False))).select(
                *cols, F.lit("antenne invalide ou date manquante").alias("rejection_reason")))
