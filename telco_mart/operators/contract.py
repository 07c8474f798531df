"""Schema contracts: what a column may hold, and what becomes of a value that
it may not.

A contract names a type, and where wanted a text width, a default and whether a
value is required, for each column. ``fit`` brings a frame to it in one pass:
missing values take the default; a value that the type cannot hold, a text that
is too long and a required value that is missing are *violations*. Every
violation is reported as a quarantine row with its reason, so nothing turns NULL
in silence: in a ``strict`` column it rejects the row, else the row stays with
the default (NULL without one), a long text cut to its width.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telco_mart.functions import cleaning as X

TOO_LARGE, TOO_LONG, ABSENT = "hors type", "texte trop long", "valeur obligatoire absente"


@dataclass(frozen=True)
class Field:
    type: str
    width: int | None = None
    default: object = None
    required: bool = False
    strict: bool = False


@dataclass(frozen=True)
class Contract:
    """``fields`` by column; ``parse``: the frame is a raw feed, whose columns are
    texts: numbers are read from them first (texts that are no numbers count as
    missing, as in cleaning)."""

    source_table: str
    key: str
    fields: dict
    parse: bool = False

    def _value(self, name: str, f: Field) -> Column:
        c = F.col(f"`{name}`")
        return X.to_number(c) if self.parse and f.type not in ("string", "date", "timestamp") else c

    def _states(self, name: str, f: Field) -> list[tuple[str, Column]]:
        """(reason, violated) of a column, in the order of reporting."""
        c, out = self._value(name, f), []
        if f.type != "string":
            out.append((f"{name} : {TOO_LARGE} {f.type}", c.isNotNull() & c.try_cast(f.type).isNull()))
        if f.width is not None:
            out.append((f"{name} : {TOO_LONG} ({f.width})", F.coalesce(F.length(c) > f.width, F.lit(False))))
        if f.required and f.default is None:
            out.append((f"{name} : {ABSENT}", c.isNull()))
        return out

    def _fitted(self, name: str, f: Field) -> Column:
        c = self._value(name, f).try_cast(f.type)
        if f.width is not None:
            c = F.substring(c, 1, f.width)
        return (c if f.default is None else F.coalesce(c, F.lit(f.default).cast(f.type))).alias(name)

    def flagged(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_broken``, an array of (reason, strict) of each row."""
        every = [F.when(violated, F.struct(F.lit(reason).alias("reason"), F.lit(f.strict).alias("strict")))
                 for name, f in self.fields.items() for reason, violated in self._states(name, f)]
        none = F.array().cast("array<struct<reason:string,strict:boolean>>")
        return df.withColumn("_broken", F.array_compact(F.array(*every)) if every else none)

    def fit(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows on the contract's columns and types, quarantine rows); columns
        that ``df`` lacks count as missing values."""
        lacking = {n: F.lit(None).cast("string" if self.parse else f.type) for n, f in self.fields.items() if n not in df.columns}
        flagged = self.flagged(df.withColumns(lacking) if lacking else df)
        kept = flagged.filter(~F.exists("_broken", lambda b: b["strict"])).select(*(self._fitted(n, f) for n, f in self.fields.items()))
        return kept, self.report(flagged)

    def report(self, flagged: DataFrame) -> DataFrame:
        """One quarantine row per violation; only those rows become text."""
        columns = [c for c in flagged.columns if not c.startswith("_")]
        rows = flagged.filter(F.size("_broken") > 0).select(
            F.lit(self.source_table).alias("source_table"), F.col(self.key).cast("string").alias("record_id"),
            F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns))).alias("raw_data"), F.explode("_broken.reason").alias("rejection_reason"))
        return rows.withColumn("rejected_at", F.current_timestamp())


def reports(pairs: list[tuple[Contract, DataFrame]]) -> DataFrame:
    """The quarantine rows of several frames under their contracts."""
    return reduce(DataFrame.unionByName, [c.fit(df)[1] for c, df in pairs])


def _texts(**widths: int) -> dict:
    return {c: Field("string", w) for c, w in widths.items()}


# Types, widths and defaults of the feeds' and the tables' columns
# (event ids are kept at any length).
FEEDS = {
    "plans": Contract("plans", "plan_id", {
        **_texts(plan_id=20, plan_name=100, country=100, type=30),
        "monthly_fee": Field("decimal(10,2)"), "data_quota_gb": Field("decimal(8,2)"), "call_minutes": Field("int"), "sms_quota": Field("int"),
    }, parse=True),
    "towers": Contract("towers", "tower_id", {
        **_texts(tower_id=20, tower_name=100, city=100, region=100, country=100, technology=10, status=20, etat_batterie=20),
        "latitude": Field("decimal(9,6)"), "longitude": Field("decimal(9,6)"), "capacity_users": Field("int", default=0),
    }, parse=True),
    "subscribers": Contract("subscribers", "subscriber_id", {
        **_texts(subscriber_id=20, first_name=100, last_name=100, city=100, country=100, plan_id=20, tower_id=20, phone_number=30, email=200, segment=30),
        "age": Field("int"), "monthly_revenue": Field("decimal(10,2)"),
    }, parse=True),
    "usage": Contract("usage", "usage_id", {
        "usage_id": Field("string"), **_texts(event_type=30, status=20, network_type=10),
        "duration_sec": Field("int", default=0), "data_mb": Field("decimal(12,4)", default=0), "amount_fcfa": Field("decimal(12,2)"), "roaming": Field("int", default=0),
    }, parse=True),
    "incidents": Contract("incidents", "incident_id", {
        **_texts(incident_id=20, incident_type=50, severity=20, description=500),
        "resolution_minutes": Field("int"), "nb_abonnes_affectes": Field("int", default=0),
    }, parse=True),
}
SNAPSHOT = Contract("fact_subscriber_monthly", "subscriber_sk", {
    "subscriber_sk": Field("bigint", required=True, strict=True), "snapshot_month": Field("string", 7, required=True, strict=True), "plan_sk": Field("bigint"),
    "data_used_mb": Field("decimal(12,2)", default=0), "voice_used_sec": Field("int", default=0), "sms_used": Field("int", default=0),
    "revenue_fcfa": Field("decimal(12,2)", default=0), "network_incidents": Field("int", default=0), "failed_calls": Field("int", default=0),
    "days_since_active": Field("int", default=0), "churn_status": Field("int", default=0),
})
