"""Canonical schemas: raw feeds (all text) and the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_COLUMNS = {
    "subscribers": ["subscriber_id", "first_name", "last_name", "gender", "age", "city",
                    "country", "plan_id", "tower_id", "subscription_date", "phone_number",
                    "email", "churn", "churn_date", "monthly_revenue", "segment"],
    "usage": ["usage_id", "subscriber_id", "tower_id", "event_type", "event_datetime",
              "duration_sec", "data_mb", "amount_fcfa", "status", "network_type", "roaming"],
    "towers": ["tower_id", "tower_name", "city", "region", "country", "latitude", "longitude",
               "capacity_users", "technology", "installation_date", "status", "etat_batterie"],
    "plans": ["plan_id", "plan_name", "country", "monthly_fee", "data_quota_gb",
              "call_minutes", "sms_quota", "type"],
    "incidents": ["incident_id", "tower_id", "incident_type", "severity", "incident_datetime",
                  "resolution_minutes", "resolved", "resolution_date", "description",
                  "nb_abonnes_affectes"],
}


def raw_schema(feed: str) -> T.StructType:
    """All-text schema of a raw feed: CSV types are never inferred."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[feed]])


# Target column types of the warehouse tables (surrogate keys are BIGINT hashes).
DIM_PLAN = {
    "plan_sk": "bigint", "plan_id": "string", "plan_name": "string",
    "type_abonnement": "string", "country": "string", "monthly_fee": "decimal(10,2)",
    "data_quota_gb": "decimal(8,2)", "call_minutes": "int", "sms_quota": "int",
    "categorie_prix": "string", "date_debut": "date", "date_fin": "date",
    "is_current": "int", "version": "int",
}
DIM_TOWER = {
    "tower_sk": "bigint", "tower_id": "string", "tower_name": "string", "city": "string",
    "region": "string", "country": "string", "latitude": "decimal(9,6)",
    "longitude": "decimal(9,6)", "capacity_users": "int", "technology": "string",
    "installation_date": "date", "status": "string", "etat_batterie": "string",
    "zone_type": "string",
}
DIM_SUBSCRIBER = {
    "subscriber_sk": "bigint", "subscriber_id": "string", "first_name": "string",
    "last_name": "string", "nom_complet": "string", "gender": "string", "age": "int",
    "tranche_age": "string", "city": "string", "country": "string", "plan_id": "string",
    "tower_id": "string", "phone_number": "string", "email": "string", "segment": "string",
    "churn": "int", "churn_date": "date", "subscription_date": "date",
    "monthly_revenue": "decimal(10,2)", "anciennete_mois": "int",
    "date_debut": "date", "date_fin": "date", "is_current": "int", "version": "int",
}
DIM_LOCATION = {
    "location_sk": "bigint", "city": "string", "region": "string", "country": "string",
    "continent": "string", "latitude": "decimal(9,6)", "longitude": "decimal(9,6)",
    "zone_type": "string", "population_zone": "string", "fuseau_horaire": "string",
}
FACT_USAGE = {
    "usage_sk": "bigint", "date_sk": "int", "subscriber_sk": "bigint", "tower_sk": "bigint",
    "plan_sk": "bigint", "location_sk": "bigint", "usage_id": "string",
    "event_hour": "int", "duration_sec": "int", "duration_min": "decimal(8,2)",
    "data_mb": "decimal(12,4)", "data_gb": "decimal(12,6)", "amount_fcfa": "decimal(12,2)",
    "event_type": "string", "status": "string", "network_type": "string", "roaming": "int",
    "annee": "int",
}
FACT_INCIDENT = {
    "incident_sk": "bigint", "tower_sk": "bigint", "date_sk": "int", "location_sk": "bigint",
    "incident_id": "string", "incident_type": "string", "severity": "string",
    "resolved": "int", "description": "string", "resolution_minutes": "int",
    "nb_abonnes_affectes": "int", "annee": "int",
}
FACT_SUBSCRIBER_MONTHLY = {
    "subscriber_sk": "bigint", "snapshot_month": "string", "plan_sk": "bigint",
    "data_used_mb": "decimal(12,2)", "voice_used_sec": "int", "sms_used": "int",
    "revenue_fcfa": "decimal(12,2)", "network_incidents": "int", "failed_calls": "int",
    "days_since_active": "int", "churn_status": "int",
}
REJECTED_ROWS = {
    "source_table": "string", "raw_data": "string", "rejection_reason": "string",
    "rejected_at": "timestamp",
}
AUDIT_LOG = {
    "table_name": "string", "operation": "string", "record_pk": "string",
    "column_name": "string", "old_value": "string", "new_value": "string",
    "changed_by": "string", "changed_at": "timestamp",
}


def conform(df: DataFrame, schema: dict[str, str], defaults: dict | None = None) -> DataFrame:
    """Project ``df`` onto ``schema`` (order and types), filling defaults for
    missing or null columns; VARCHAR lengths are not enforced here."""
    defaults = defaults or {}
    cols: list[Column] = []
    for name, typ in schema.items():
        c = F.col(name) if name in df.columns else F.lit(None)
        if name in defaults:
            c = F.coalesce(c, F.lit(defaults[name]))
        cols.append(c.try_cast(typ).alias(name))
    return df.select(*cols)
