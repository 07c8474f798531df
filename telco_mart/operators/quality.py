"""Declarative data-quality rules with a quarantine.

A rule is *fix* (rewrite columns), *warn* (keep the row, copy it to the
quarantine) or *reject* (drop the row, copy it to the quarantine). Rules run
in order, so a rule sees the values fixed by earlier rules; everything is a
column expression evaluated in one pass, set-based rather than per row.

Quarantine rows follow the rejected-rows contract:
``source_table, record_id, raw_data, rejection_reason, rejected_at``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telco_mart import config as C
from telco_mart.functions import cleaning as X


@dataclass
class Rule:
    name: str
    kind: str                       # "fix" | "warn" | "reject"
    violation: Column | None = None  # for warn / reject (NULL counts as no violation)
    fixes: dict = field(default_factory=dict)  # column -> expression, for fix
    reason: str = ""


@dataclass
class RuleSet:
    source_table: str
    key: str
    rules: list
    raw_width: int | None = None  # cut of raw_data, for a store with a width

    def _evaluate(self, df: DataFrame) -> tuple[DataFrame, list]:
        cols = list(df.columns)
        flags = []
        raw = F.to_json(F.struct(*cols))
        out = df.withColumn("_dq_raw", raw if self.raw_width is None else F.substring(raw, 1, self.raw_width))
        for r in self.rules:
            if r.kind == "fix":
                out = out.withColumns({c: e for c, e in r.fixes.items()})
            elif r.kind in ("warn", "reject"):
                flag = f"_dq_{r.name}"
                out = out.withColumn(flag, F.coalesce(r.violation, F.lit(False)))
                flags.append((flag, r))
            else:
                raise ValueError(r.kind)
        return out, flags

    def apply(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        cols = list(df.columns)
        out, flags = self._evaluate(df)
        rejects = [f for f, r in flags if r.kind == "reject"]
        keep = F.lit(True)
        for f in rejects:
            keep = keep & ~F.col(f)
        clean = out.filter(keep).select(*cols)
        if not flags:
            quarantine = out.limit(0).select(
                F.lit(self.source_table).alias("source_table"),
                F.col(self.key).cast("string").alias("record_id"),
                F.col("_dq_raw").alias("raw_data"),
                F.lit("").alias("rejection_reason"),
                F.current_timestamp().alias("rejected_at"))
            return clean, quarantine
        reasons = F.array_compact(F.array(*[F.when(F.col(f), F.lit(r.reason)) for f, r in flags]))
        any_flag = F.lit(False)
        for f, _ in flags:
            any_flag = any_flag | F.col(f)
        # only flagged rows are serialised to text
        quarantine = (out.filter(any_flag).select(F.col(self.key).cast("string").alias("record_id"),
                                 F.col("_dq_raw").alias("raw_data"),
                                 F.explode(reasons).alias("rejection_reason"))
                      .select(F.lit(self.source_table).alias("source_table"), "record_id",
                              "raw_data", "rejection_reason",
                              F.current_timestamp().alias("rejected_at")))
        return clean, quarantine

    def flagged(self, df: DataFrame) -> DataFrame:
        """``df`` with fixes applied, and what ``quarantined`` needs later: a flag
        per rule and the fixed columns as they came (no text is made yet). Only
        for rule sets that warn and fix."""
        fixed = sorted({c for r in self.rules for c in r.fixes})
        out = df.withColumns({f"_came_{c}": F.col(c) for c in fixed})
        for r in self.rules:
            if r.kind == "fix":
                out = out.withColumns(r.fixes)
            elif r.kind == "warn":
                out = out.withColumn(f"_dq_{r.name}", F.coalesce(r.violation, F.lit(False)))
            else:
                raise ValueError(f"{r.kind} rules drop rows; use apply")
        return out

    def quarantined(self, flagged: DataFrame, columns: list[str]) -> DataFrame:
        """Quarantine rows of ``flagged`` rows, with ``columns`` as they came."""
        warns = [r for r in self.rules if r.kind == "warn"]
        fixed = {c for r in self.rules for c in r.fixes}
        raw = F.to_json(F.struct(*(F.col(f"_came_{c}").alias(c) if c in fixed else F.col(c) for c in columns)))
        reasons = F.array_compact(F.array(*[F.when(F.col(f"_dq_{r.name}"), F.lit(r.reason)) for r in warns]))
        rows = flagged.filter(F.size(reasons) > 0).select(
            F.lit(self.source_table).alias("source_table"), F.col(self.key).cast("string").alias("record_id"),
            (raw if self.raw_width is None else F.substring(raw, 1, self.raw_width)).alias("raw_data"), F.explode(reasons).alias("rejection_reason"))
        return rows.withColumn("rejected_at", F.current_timestamp())


def subscriber_rules(as_of: str) -> RuleSet:
    as_of_d = F.lit(as_of).cast("date")
    return RuleSet("dim_subscriber", "subscriber_id", [
        Rule("age_range", "fix", fixes={"age": X.in_range_or_null(F.col("age"), C.AGE_MIN, C.AGE_MAX)}),
        Rule("gender", "fix", fixes={"gender": F.when(F.col("gender").isNull(), F.col("gender"))
                                     .when(F.col("gender").isin("M", "F"), F.col("gender"))
                                     .otherwise(F.lit(C.UNKNOWN))}),
        Rule("email", "fix", fixes={"email": X.valid_email(F.col("email"))}),
        Rule("location", "reject", violation=F.col("city").isNull() | F.col("country").isNull(),
             reason="Ville ou pays manquant"),
        Rule("churn_date", "fix", fixes={"churn_date": F.when(F.col("churn") == 0, F.lit(None).cast("date"))
                                         .when((F.col("churn") == 1) & F.col("churn_date").isNull(), as_of_d)
                                         .otherwise(F.col("churn_date"))}),
    ])


#: Amounts from here on do not fit the fact's DECIMAL columns.
USAGE_LIMITS = {"data_mb": 1e8, "amount_fcfa": 1e10}


def usage_rules(data_type: str = C.DATA_TYPE) -> RuleSet:
    out_of_range = lambda c: F.abs(F.col(c)) >= F.lit(USAGE_LIMITS[c])
    return RuleSet("fact_usage", "usage_id", [
        Rule("range", "warn", violation=F.coalesce(out_of_range("data_mb"), F.lit(False)) | F.coalesce(out_of_range("amount_fcfa"), F.lit(False)),
             reason="Valeur numérique hors limites"),
        Rule("range_fix", "fix", fixes={c: F.when(~out_of_range(c), F.col(c)) for c in USAGE_LIMITS}),
        Rule("non_negative", "fix", fixes={
            "duration_sec": X.non_negative(F.col("duration_sec")),
            "data_mb": X.non_negative(F.col("data_mb")).cast("double"),
            "amount_fcfa": X.negative_to_null(F.col("amount_fcfa")),
        }),
        Rule("data_zero", "warn",
             violation=(F.col("event_type") == data_type) & (F.col("data_mb") == 0),
             reason="Data event with data_mb = 0"),
    ])


def incident_rules() -> RuleSet:
    return RuleSet("fact_incident", "incident_id", [
        Rule("unresolved", "fix", fixes={
            "resolution_minutes": F.when(F.col("resolved") == 0, F.lit(None).cast("int"))
                                   .otherwise(F.col("resolution_minutes"))}),
        Rule("affected", "fix", fixes={"nb_abonnes_affectes": X.non_negative(F.col("nb_abonnes_affectes"))}),
    ])


def tower_rules() -> RuleSet:
    return RuleSet("dim_tower", "tower_id", [
        Rule("geo", "fix", fixes={
            "latitude": X.in_range_or_null(F.col("latitude"), -90, 90),
            "longitude": X.in_range_or_null(F.col("longitude"), -180, 180)}),
        Rule("capacity", "fix", fixes={"capacity_users": X.non_negative(F.col("capacity_users"))}),
    ])


def calendar_gaps(dates: DataFrame, date_col: str, calendar: DataFrame, source: str) -> DataFrame:
    """Distinct source dates (as DATE) missing from the calendar."""
    d = dates.select(F.col(date_col).cast("date").alias("date_complete")).filter(
        F.col("date_complete").isNotNull()).distinct()
    return (d.join(calendar.select("date_complete"), "date_complete", "left_anti")
            .select(F.lit(source).alias("source"), "date_complete"))


def day_gaps(dates: DataFrame, source_col: str = "source", day_col: str = "day") -> DataFrame:
    """Gaps between a source's days: (source, gap_start, gap_end, days) of every
    run of days without a row between its first and its last. Rows are collapsed
    to days map-side, so the window runs over at most one row a day and source;
    null days are no days."""
    days = dates.select(F.col(source_col).alias("source"), F.col(day_col).cast("date").alias("day")).filter("day is not null").distinct()
    after = F.lead("day").over(Window.partitionBy("source").orderBy("day"))
    return (days.withColumn("_next", after).filter(F.datediff("_next", "day") > 1)
            .select("source", F.date_add("day", 1).alias("gap_start"), F.date_sub("_next", 1).alias("gap_end"), (F.datediff("_next", "day") - 1).alias("days")))


def completeness_report(subscribers: DataFrame, usage: DataFrame, incidents: DataFrame) -> DataFrame:
    """Three-branch completeness report over the current warehouse; scores are
    rounded half-up exactly (integer arithmetic)."""
    from telco_mart.operators.marts import ratio
    s = subscribers.filter(F.col("is_current") == 1)
    n = F.count(F.lit(1))
    sub = s.agg(
        F.lit("dim_subscriber").alias("table_name"), n.alias("total_lignes"),
        F.count_if(F.col("age").isNull()).alias("age_manquant"),
        F.count_if(F.col("email").isNull()).alias("email_manquant"),
        F.count_if(F.col("gender") == C.UNKNOWN).alias("genre_inconnu"))
    sub = sub.withColumn("score_completude_pct", ratio(
        F.col("total_lignes") * 2 - F.col("age_manquant") - F.col("email_manquant"),
        F.col("total_lignes") * 2, 2, mult=100))

    def one(df, table, col):
        a = df.agg(F.lit(table).alias("table_name"), n.alias("total_lignes"),
                   F.count_if(F.col(col).isNull()).alias("age_manquant"))
        return a.withColumn("score_completude_pct", ratio(
            F.col("total_lignes") - F.col("age_manquant"), F.col("total_lignes"), 2, mult=100))
    return (sub.unionByName(one(usage, "fact_usage", "amount_fcfa"), allowMissingColumns=True)
            .unionByName(one(incidents, "fact_incident", "resolution_minutes"), allowMissingColumns=True))
