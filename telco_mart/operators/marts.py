"""The seven KPI marts.

Plan shape (usage marts): the fact is first restricted to calendar days
(broadcast semi-join: the calendar is bounded by its span), then aggregated
to (month, dimension keys[, subscriber]) *before* any dimension join, so the
joins see one row per group instead of one per event. Month names and quarters
are looked up for the finished groups, so shuffled rows carry the month's key only. Ratios are computed in
DOUBLE from exact DECIMAL/BIGINT sums and rounded last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telco_mart import config as C
from telco_mart.operators.calendar import month_calendar
from telco_mart.operators.dimensions import current


def ratio(num, den, digits: int, num_scale: int = 0, mult: int = 1, div: int = 1, even: bool = False) -> Column:
    """round_half_up(num * mult / (den * div), digits) as DOUBLE; NULL when the
    denominator is 0 or NULL.

    ``num`` is an integer, or a DECIMAL with ``num_scale`` decimals; ``den`` an
    integer. The quotient is rounded exactly in 64-bit integers,
    q = floor((2 N 10^d + D) / 2D), so a tie such as 67376.805 always goes up
    (floating-point division would see 67376.80499...). ``even``: ties go to the
    even digit instead, as the dashboard's rounding does."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    n = (num * F.lit(10 ** num_scale)).cast("long") * F.lit(mult)
    d = den.cast("long") * F.lit(10 ** num_scale * div)
    p = 10 ** digits
    a = n * F.lit(2 * p) + d
    b = d * F.lit(2)
    q = (a - a % b) / b
    if even:
        q = q - F.when((a % b == 0) & (q % 2 == 1), 1.0).otherwise(0.0)
    return F.when(d != 0, q / F.lit(float(p))).cast("double")


def dround(c, digits: int) -> Column:
    """Round an exact value and present it as DOUBLE."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits).cast("double")


def _in_calendar(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    days = F.broadcast(calendar.select("date_sk"))
    return fact.join(days, "date_sk", "left_semi").withColumn(
        "month_key", (F.col("date_sk") / 100).cast("int"))


def _months(calendar: DataFrame) -> DataFrame:
    return F.broadcast(month_calendar(calendar))


def kpi_churn_mensuel(dim_subscriber: DataFrame, dim_plan: DataFrame, calendar: DataFrame,
                      as_of: str) -> DataFrame:
    """Current subscribers on their current plan, placed on the calendar day of
    their churn (or ``as_of`` when they have not churned)."""
    s = current(dim_subscriber).withColumn(
        "date_complete", F.coalesce(F.col("churn_date"), F.lit(as_of).cast("date")))
    p = current(dim_plan).select("plan_id", "plan_name", "type_abonnement")
    cal = F.broadcast(calendar.select("date_complete", "annee", "mois", "nom_mois", "annee_trimestre"))
    j = s.join(p, "plan_id").join(cal, "date_complete")
    g = j.groupBy("annee", "mois", "nom_mois", "annee_trimestre", "country", "city", "segment",
                  "plan_name", "type_abonnement")
    return g.agg(F.countDistinct("subscriber_sk").alias("total_abonnes"),
                 F.sum("churn").cast("bigint").alias("nb_churnes")).withColumn(
        "taux_churn_pct", ratio("nb_churnes", "total_abonnes", 2, mult=100))


def kpi_arpu(fact_usage: DataFrame, dim_subscriber: DataFrame, dim_plan: DataFrame,
             calendar: DataFrame) -> DataFrame:
    f = _in_calendar(fact_usage.filter(F.col("amount_fcfa").isNotNull()), calendar)
    pre = f.groupBy("month_key", "subscriber_sk", "plan_sk").agg(
        F.sum("amount_fcfa").alias("amt"), F.count("amount_fcfa").alias("n"))
    s = dim_subscriber.select("subscriber_sk", "country", "city")
    p = dim_plan.select("plan_sk", "plan_name", "type_abonnement")
    j = pre.join(s, "subscriber_sk").join(p, "plan_sk")
    g = j.groupBy("month_key", "country", "city", "plan_name", "type_abonnement").agg(
        F.countDistinct("subscriber_sk").alias("nb_abonnes_actifs"),
        F.sum("amt").alias("amt"), F.sum("n").alias("n")).join(_months(calendar), "month_key")
    return g.select("annee", "mois", "nom_mois", "annee_trimestre", "country", "city",
                    "plan_name", "type_abonnement", "nb_abonnes_actifs",
                    dround("amt", 2).alias("revenu_total"),
                    ratio("amt", "n", 2, num_scale=2).alias("revenu_moyen_par_evenement"),
                    ratio("amt", "nb_abonnes_actifs", 2, num_scale=2).alias("arpu"))


def kpi_utilisation_reseau(fact_usage: DataFrame, dim_tower: DataFrame, calendar: DataFrame) -> DataFrame:
    f = _in_calendar(fact_usage, calendar)
    pre = f.groupBy("month_key", "tower_sk").agg(
        F.countDistinct("subscriber_sk").alias("abonnes_actifs"),
        F.count("usage_sk").alias("nb_evenements"),
        F.sum("data_mb").alias("mb"), F.sum("duration_sec").alias("sec"))
    t = dim_tower.select("tower_sk", "tower_id", "tower_name", "city", "country", "technology",
                         "capacity_users")
    j = pre.join(t, "tower_sk").join(_months(calendar), "month_key")
    return j.select("annee", "mois", "nom_mois", "tower_id", "tower_name", "city", "country",
                    "technology", "capacity_users", "abonnes_actifs", "nb_evenements",
                    ratio("abonnes_actifs", "capacity_users", 2, mult=100).alias("taux_utilisation_pct"),
                    ratio("mb", F.lit(1), 2, num_scale=4, div=1024).alias("volume_data_gb"),
                    ratio("sec", F.lit(1), 2, div=3600).alias("volume_appels_heures"))


def kpi_incidents_qualite(fact_incident: DataFrame, dim_tower: DataFrame, calendar: DataFrame) -> DataFrame:
    f = _in_calendar(fact_incident, calendar)
    pre = f.groupBy("month_key", "tower_sk").agg(
        F.count("incident_sk").alias("nb_incidents"),
        F.count_if(F.col("severity") == C.SEVERITY_HIGH).alias("incidents_eleves"),
        F.count_if(F.col("severity") == C.SEVERITY_MEDIUM).alias("incidents_moyens"),
        F.sum("nb_abonnes_affectes").cast("bigint").alias("total_abonnes_affectes"),
        F.sum("resolution_minutes").alias("res_sum"), F.count("resolution_minutes").alias("res_n"),
        F.sum("resolved").alias("resolved_n"), F.count(F.lit(1)).alias("n"))
    t = dim_tower.select("tower_sk", "tower_id", "tower_name", "city", "country", "technology")
    j = pre.join(t, "tower_sk").join(_months(calendar), "month_key")
    return j.select("annee", "mois", "nom_mois", "tower_id", "tower_name", "city", "country",
                    "technology", "nb_incidents", "incidents_eleves", "incidents_moyens",
                    "total_abonnes_affectes",
                    ratio("res_sum", "res_n", 1).alias("duree_resolution_moy_min"),
                    ratio("resolved_n", "n", 2, mult=100).alias("taux_resolution_pct"))


def kpi_duree_appels(fact_usage: DataFrame, dim_subscriber: DataFrame, calendar: DataFrame,
                     call_types=tuple(C.CALL_TYPES)) -> DataFrame:
    """Calls by month and subscriber place/segment. ``tranche_horaire`` comes
    from the daily calendar, where it is always NULL (kept for parity; see
    ``rollups.call_band`` for the band derived from the event hour)."""
    f = _in_calendar(fact_usage.filter(F.col("event_type").isin(list(call_types))), calendar)
    pre = f.groupBy("month_key", "subscriber_sk", "network_type").agg(
        F.count("usage_sk").alias("n"), F.sum("duration_sec").alias("sec"),
        F.count("duration_sec").alias("sec_n"),
        F.count_if(F.col("status") == C.STATUS_FAILED).alias("failed"))
    s = dim_subscriber.select("subscriber_sk", "country", "city", "segment")
    months = _months(calendar).withColumn("tranche_horaire", F.lit(None).cast("string"))
    j = pre.join(s, "subscriber_sk")
    g = j.groupBy("month_key", "country", "city", "segment", "network_type").agg(
        F.sum("n").alias("nb_appels"), F.sum("sec").alias("sec"), F.sum("sec_n").alias("sec_n"),
        F.sum("failed").alias("nb_appels_echoues")).join(months, "month_key")
    return g.select("annee", "mois", "nom_mois", "annee_trimestre", "tranche_horaire", "country",
                    "city", "segment", "network_type", "nb_appels",
                    ratio("sec", "sec_n", 1).alias("duree_moy_sec"),
                    ratio("sec", "sec_n", 2, div=60).alias("duree_moy_min"),
                    ratio("sec", F.lit(1), 2, div=3600).alias("volume_total_heures"),
                    "nb_appels_echoues",
                    ratio("nb_appels_echoues", "nb_appels", 2, mult=100).alias("taux_echec_pct"))


def kpi_retention_par_offre(dim_subscriber: DataFrame, dim_plan: DataFrame) -> DataFrame:
    s = current(dim_subscriber)
    p = current(dim_plan).select("plan_id", "plan_name", "type_abonnement",
                                 F.col("country").alias("plan_country"), "monthly_fee")
    g = s.join(p, "plan_id").groupBy("plan_name", "type_abonnement", "plan_country", "monthly_fee").agg(
        F.countDistinct("subscriber_sk").alias("total_abonnes"),
        F.count_if(F.col("churn") == 0).alias("abonnes_retenus"),
        F.sum("churn").cast("bigint").alias("abonnes_perdus"),
        F.count(F.lit(1)).alias("n"),
        F.sum("anciennete_mois").alias("ten_sum"), F.count("anciennete_mois").alias("ten_n"))
    return g.select("plan_name", "type_abonnement", F.col("plan_country").alias("country"),
                    F.col("monthly_fee").cast("double").alias("monthly_fee"),
                    "total_abonnes", "abonnes_retenus", "abonnes_perdus",
                    ratio("abonnes_retenus", "n", 2, mult=100).alias("taux_retention_pct"),
                    ratio("abonnes_perdus", "n", 2, mult=100).alias("taux_churn_pct"),
                    ratio("ten_sum", "ten_n", 1).alias("anciennete_moy_mois"))


def kpi_data_par_region(fact_usage: DataFrame, dim_location: DataFrame, dim_tower: DataFrame,
                        calendar: DataFrame, data_type: str = C.DATA_TYPE) -> DataFrame:
    f = _in_calendar(fact_usage.filter(F.col("event_type") == data_type), calendar)
    pre = f.groupBy("month_key", "location_sk", "tower_sk", "subscriber_sk").agg(
        F.count("usage_sk").alias("n"), F.sum("data_mb").alias("mb"),
        F.count("data_mb").alias("mb_n"), F.sum("data_gb").alias("gb"),
        F.sum("amount_fcfa").alias("amt"))
    loc = dim_location.select("location_sk", "country", "city", "region")
    t = dim_tower.select("tower_sk", "technology")
    j = pre.join(loc, "location_sk").join(t, "tower_sk")
    g = j.groupBy("month_key", "country", "city", "region", "technology").agg(
        F.countDistinct("subscriber_sk").alias("abonnes_data"),
        F.sum("n").alias("nb_sessions_data"), F.sum("mb").alias("mb"), F.sum("mb_n").alias("mb_n"),
        F.sum("gb").alias("gb"), F.sum("amt").alias("amt")).join(_months(calendar), "month_key")
    return g.select("annee", "mois", "nom_mois", "annee_trimestre", "country", "city", "region",
                    "technology", "abonnes_data", "nb_sessions_data",
                    dround("mb", 2).alias("total_mb"), dround("gb", 4).alias("total_gb"),
                    ratio("mb", "mb_n", 2, num_scale=4).alias("data_moy_par_session_mb"),
                    dround("amt", 2).alias("revenu_data_total"))
