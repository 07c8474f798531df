"""Roll-ups of the KPI marts and the dashboard data products.

They read the (small, materialised) KPI tables. Averages of ratios and sums
of distinct counts are reproduced as the original defines them even though
they are not additive; ``exact_*`` variants recompute from the facts.
Averages of rounded values are taken exactly: the values are DECIMALs with a
known scale, summed exactly, then rounded half-up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telco_mart import config as C
from telco_mart.operators.calendar import hour_band
from telco_mart.operators.dimensions import current
from telco_mart.operators.marts import ratio


def _avg(col: str, scale: int, digits: int) -> tuple[Column, Column]:
    """(sum, count) parts for an exact average of a column holding values with
    ``scale`` decimals."""
    return (F.sum(F.col(col).cast(f"decimal(20,{scale})")), F.count(col))


def avg_round(col: str, scale: int, digits: int, alias: str) -> list:
    s, n = _avg(col, scale, digits)
    return [s.alias(f"_{alias}_s"), n.alias(f"_{alias}_n")]


def finish_avg(alias: str, scale: int, digits: int) -> Column:
    return ratio(f"_{alias}_s", f"_{alias}_n", digits, num_scale=scale).alias(alias)


def sum_round(col: str, scale: int, digits: int) -> Column:
    return F.round(F.sum(F.col(col).cast(f"decimal(20,{scale})")), digits).cast("double")


def periode(annee="annee", mois="mois") -> Column:
    return F.concat_ws("-", F.col(annee).cast("string"), F.lpad(F.col(mois).cast("string"), 2, "0"))


def _drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def rup_arpu_month(kpi_arpu: DataFrame) -> DataFrame:
    g = kpi_arpu.groupBy("annee", "mois", "country").agg(
        *avg_round("arpu", 2, 0, "arpu_fcfa"),
        sum_round("revenu_total", 2, 0).alias("revenu_total"),
        F.sum("nb_abonnes_actifs").alias("nb_abonnes"))
    return _drop_helpers(g.withColumn("arpu_fcfa", finish_avg("arpu_fcfa", 2, 0))
                         .withColumn("periode", periode())).orderBy("annee", "mois", "country")


def rup_churn_month(kpi_churn: DataFrame) -> DataFrame:
    g = kpi_churn.groupBy("annee", "mois", "country").agg(
        F.sum("total_abonnes").alias("total_abonnes"), F.sum("nb_churnes").alias("nb_churnes"))
    return (g.withColumn("periode", periode())
            .withColumn("taux_pct", ratio("nb_churnes", "total_abonnes", 2, mult=100, even=True))
            .orderBy("annee", "mois", "country"))


def rup_exec_summary(arpu_month: DataFrame, churn_month: DataFrame) -> DataFrame:
    """One row of executive figures."""
    arpu = arpu_month.agg(F.sum(F.col("arpu_fcfa").cast("decimal(20,0)")).alias("_as"), F.count("arpu_fcfa").alias("_an"),
                          F.sum(F.col("revenu_total").cast("decimal(24,0)")).alias("_rev"))
    # one pass over the churn roll-up: months, then one row
    months = churn_month.groupBy("periode").agg(F.sum("total_abonnes").alias("_t"), F.sum("nb_churnes").alias("_c"))
    churn = months.agg(F.sum("_t").alias("_ts"), F.count(F.lit(1)).alias("_tn"), F.sum("_c").alias("total_churnes"))
    both = arpu.unionByName(churn, allowMissingColumns=True)  # two rows folded into one
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        F.coalesce(ratio("_as", "_an", 0, even=True), F.lit(0.0)).alias("arpu_global"),
        F.coalesce(F.col("_rev").cast("bigint"), F.lit(0)).alias("revenu_total"),
        F.coalesce(F.floor(F.col("_ts") / F.col("_tn")).cast("bigint"), F.lit(0)).alias("moy_abonnes"),
        F.coalesce("total_churnes", F.lit(0)).cast("bigint").alias("total_churnes"),
        F.coalesce(ratio("total_churnes", "_ts", 2, mult=100, even=True), F.lit(0.0)).alias("taux_churn"))


def rup_data_city(kpi_data: DataFrame) -> DataFrame:
    g = kpi_data.groupBy("country", "city").agg(
        F.sum(F.col("total_mb").cast("decimal(20,2)")).alias("_mb"),
        F.sum("nb_sessions_data").alias("nb_sessions"),
        F.sum("abonnes_data").alias("abonnes_actifs"))
    return (g.withColumn("volume_go", ratio("_mb", F.lit(1), 1, num_scale=2, div=1024))
            .withColumn("localisation", F.concat_ws(", ", "city", "country"))
            .drop("_mb").orderBy(F.col("volume_go").desc(), "country", "city"))


def rup_incident_city(kpi_inc: DataFrame) -> DataFrame:
    g = kpi_inc.groupBy("country", "city").agg(
        F.sum("nb_incidents").alias("total_incidents"),
        F.sum("incidents_eleves").alias("incidents_graves"),
        F.sum("incidents_moyens").alias("incidents_moderes"),
        F.sum("total_abonnes_affectes").alias("abonnes_touches"),
        *avg_round("duree_resolution_moy_min", 1, 0, "resolution_moy_min"),
        *avg_round("taux_resolution_pct", 2, 1, "taux_resolution"))
    return _drop_helpers(g.withColumn("resolution_moy_min", finish_avg("resolution_moy_min", 1, 0))
                         .withColumn("taux_resolution", finish_avg("taux_resolution", 2, 1))
                         ).orderBy(F.col("total_incidents").desc(), "country", "city")


def rup_saturation(kpi_util: DataFrame) -> DataFrame:
    g = kpi_util.groupBy("country", "technology").agg(
        *avg_round("taux_utilisation_pct", 2, 1, "utilisation_pct"),
        sum_round("volume_data_gb", 2, 0).alias("volume_go"),
        F.sum("abonnes_actifs").alias("abonnes"))
    return _drop_helpers(g.withColumn("utilisation_pct", finish_avg("utilisation_pct", 2, 1)))


def rup_severity(incident_city: DataFrame) -> DataFrame:
    """Severity totals in long form (two rows)."""
    t = incident_city.agg(F.sum("incidents_graves").alias("Élevée"),
                          F.sum("incidents_moderes").alias("Modérée"))
    return t.unpivot([], ["Élevée", "Modérée"], "gravite", "nombre").select(
        "gravite", F.coalesce(F.col("nombre"), F.lit(0)).cast("bigint").alias("nombre"))


def rup_retention(kpi_ret: DataFrame) -> DataFrame:
    return kpi_ret.select(
        "plan_name", "type_abonnement", "country",
        F.round(F.col("monthly_fee").cast("decimal(12,2)"), 0).cast("double").alias("prix_fcfa"),
        "total_abonnes", "abonnes_retenus", "abonnes_perdus", "taux_retention_pct", "taux_churn_pct",
        F.col("anciennete_moy_mois").alias("anciennete_mois"),
    ).orderBy(F.col("taux_retention_pct").desc(), "plan_name", "country")


def rup_retention_summary(kpi_ret: DataFrame) -> DataFrame:
    t = kpi_ret.agg(F.sum("total_abonnes").alias("total_abonnes"),
                    F.sum("abonnes_retenus").alias("abonnes_fideles"),
                    F.countDistinct("plan_name").alias("nb_forfaits"))
    return t.select("total_abonnes", "abonnes_fideles",
                    F.coalesce(ratio("abonnes_fideles", "total_abonnes", 1, mult=100, even=True), F.lit(0.0))
                    .alias("taux_fidelisation"), "nb_forfaits")


def rup_calls_network(kpi_calls: DataFrame) -> DataFrame:
    g = kpi_calls.groupBy("network_type").agg(
        F.sum("nb_appels").alias("nb_appels"),
        *avg_round("duree_moy_min", 2, 1, "duree_moy_min"),
        sum_round("volume_total_heures", 2, 0).alias("volume_heures"),
        *avg_round("taux_echec_pct", 2, 2, "taux_echec_pct"))
    return _drop_helpers(g.withColumn("duree_moy_min", finish_avg("duree_moy_min", 2, 1))
                         .withColumn("taux_echec_pct", finish_avg("taux_echec_pct", 2, 2))
                         ).orderBy(F.col("volume_heures").desc(), "network_type")


def filter_kpi(df: DataFrame, **params) -> DataFrame:
    """Dashboard parameter filter: ``country='X'`` or ``segment=['A','B']``;
    None means no filter on that column."""
    for col, val in params.items():
        if val is None:
            continue
        df = df.filter(F.col(col).isin(list(val)) if isinstance(val, (list, tuple, set))
                       else F.col(col) == val)
    return df


def rup_alert(kpi_util: DataFrame, threshold: float = 80.0) -> DataFrame:
    """Tower-months above the saturation threshold."""
    return kpi_util.filter(F.col("taux_utilisation_pct") > threshold)


def rup_mttr(fact_incident: DataFrame, dim_tower: DataFrame) -> DataFrame:
    """Mean time to resolve per network technology (incidents pre-aggregated
    per tower before the tower join)."""
    pre = fact_incident.groupBy("tower_sk").agg(
        F.count(F.lit(1)).alias("n"), F.sum("resolution_minutes").alias("s"),
        F.count("resolution_minutes").alias("k"))
    g = pre.join(dim_tower.select("tower_sk", "technology"), "tower_sk").groupBy("technology").agg(
        F.sum("n").alias("nb_incidents"), F.sum("s").alias("_s"), F.sum("k").alias("_k"))
    return g.select("technology", "nb_incidents", ratio("_s", "_k", 1).alias("mttr_min"))


def rup_plan_share(dim_subscriber: DataFrame, dim_plan: DataFrame) -> DataFrame:
    """Current subscribers per plan type and their share of all."""
    s = current(dim_subscriber).select("plan_id")
    p = current(dim_plan).select("plan_id", "type_abonnement")
    g = s.join(p, "plan_id").groupBy("type_abonnement").agg(F.count(F.lit(1)).alias("nb_abonnes"))
    total = g.agg(F.sum("nb_abonnes")).scalar()
    return g.select("type_abonnement", "nb_abonnes", ratio("nb_abonnes", total, 2, mult=100).alias("part_pct"))


def rup_call_band(fact_usage: DataFrame, dim_subscriber: DataFrame,
                  call_types=tuple(C.CALL_TYPES)) -> DataFrame:
    """Mean call duration by time-of-day band (from the event hour) and segment."""
    f = fact_usage.filter(F.col("event_type").isin(list(call_types)))
    pre = f.groupBy("subscriber_sk", hour_band("event_hour").alias("tranche_horaire")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration_sec").alias("s"))
    g = pre.join(dim_subscriber.select("subscriber_sk", "segment"), "subscriber_sk").groupBy(
        "tranche_horaire", "segment").agg(F.sum("n").alias("nb_appels"), F.sum("s").alias("_s"))
    return g.select("tranche_horaire", "segment", "nb_appels",
                    ratio("_s", "nb_appels", 1).alias("duree_moy_sec"),
                    ratio("_s", "nb_appels", 2, div=60).alias("duree_moy_min"))


def exact_arpu_month(fact_usage: DataFrame, dim_subscriber: DataFrame) -> DataFrame:
    """ARPU per (year, month, country) recomputed from the fact (distinct
    subscribers counted once per month, unlike the roll-up of the mart)."""
    f = fact_usage.filter(F.col("amount_fcfa").isNotNull()).withColumn(
        "month_key", (F.col("date_sk") / 100).cast("int"))
    pre = f.groupBy("month_key", "subscriber_sk").agg(F.sum("amount_fcfa").alias("amt"))
    g = (pre.join(dim_subscriber.select("subscriber_sk", "country"), "subscriber_sk")
         .groupBy("month_key", "country").agg(F.sum("amt").alias("amt"),
                                              F.countDistinct("subscriber_sk").alias("nb_abonnes")))
    return g.select((F.col("month_key") / 100).cast("int").alias("annee"),
                    (F.col("month_key") % 100).cast("int").alias("mois"), "country", "nb_abonnes",
                    F.col("amt").cast("double").alias("revenu_total"),
                    ratio("amt", "nb_abonnes", 2, num_scale=2).alias("arpu"))


def relabel(df: DataFrame, labels: dict[str, str], first: list[str] = ()) -> DataFrame:
    """``df`` with business labels for column names, the columns of ``first``
    (that it has) before the others; columns without a label keep their name."""
    order = [c for c in first if c in df.columns] + [c for c in df.columns if c not in first]
    return df.select(*(F.col(c).alias(labels.get(c, c)) for c in order))
