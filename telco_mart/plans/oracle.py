"""DuckDB oracle SQL for the registered queries.

The oracle is written independently of the Spark code: it derives the
*expected* clean tables straight from the driver tables (the outcome of every
injected dirty value is spelled out), then states each query in plain SQL.
Tables ``region nation customer supplier part orders lineitem events`` are
views registered by the checker.
"""

from __future__ import annotations

from telco_mart.plans.warehouse import DRIVER_CONFIG

CFG = DRIVER_CONFIG
AS_OF = CFG.as_of

MONTHS_FR = "['Janvier','Février','Mars','Avril','Mai','Juin','Juillet','Août','Septembre','Octobre','Novembre','Décembre']"

BASE = f"""
counts AS (
  SELECT (SELECT count(*) FROM part) AS n_plans, (SELECT count(*) FROM supplier) AS n_towers),
geo AS (
  SELECT n.n_nationkey, n.n_name AS city, r.r_name AS country
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
plans_s AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS plan_id, p_name AS plan_name, r_name AS country,
         CASE WHEN p_partkey % 97 <> 96 THEN CAST(p_retailprice AS DECIMAL(10,2)) END AS monthly_fee,
         CAST(p_size AS DECIMAL(8,2)) AS data_quota_gb,
         CAST(p_size * 60 AS INTEGER) AS call_minutes, CAST(p_size * 20 AS INTEGER) AS sms_quota,
         p_type AS type_abonnement,
         CASE WHEN p_partkey % 97 = 96 THEN 'Premium'
              WHEN CAST(p_retailprice AS DECIMAL(10,2)) <
                   (CASE r_name WHEN 'AFRICA' THEN 930.0 WHEN 'EUROPE' THEN 920.0 ELSE 950.0 END)
              THEN 'Économique'
              WHEN CAST(p_retailprice AS DECIMAL(10,2)) <
                   (CASE r_name WHEN 'AFRICA' THEN 970.0 WHEN 'EUROPE' THEN 980.0 ELSE 990.0 END)
              THEN 'Standard' ELSE 'Premium' END AS categorie_prix
  FROM part LEFT JOIN region ON p_partkey % 5 = r_regionkey),
towers_raw AS (
  SELECT s_suppkey AS k, 'T' || CAST(s_suppkey AS VARCHAR) AS tower_id, s_name AS tower_name, g.city,
         'Zone-' || CAST(s_suppkey % 3 AS VARCHAR) AS region, g.country,
         CAST((s_suppkey * 37) % 200 - 100 AS DOUBLE) AS latitude,
         CAST((s_suppkey * 53) % 400 - 200 AS DOUBLE) AS longitude,
         CAST(CASE WHEN s_suppkey % 31 = 30 THEN -1 ELSE 500 + (s_suppkey % 5) * 250 END AS INTEGER) AS capacity_users,
         CASE s_suppkey % 3 WHEN 0 THEN '2G' WHEN 1 THEN '3G' ELSE '4G' END AS technology,
         DATE '2010-01-01' + CAST((s_suppkey * 17) % 3650 AS INTEGER) AS installation_date,
         CASE WHEN s_suppkey % 10 < 8 THEN 'Actif' WHEN s_suppkey % 10 = 8 THEN 'Maintenance'
              ELSE 'Inconnu' END AS status,
         CASE s_suppkey % 4 WHEN 0 THEN 'Bon' WHEN 1 THEN 'Moyen' WHEN 2 THEN 'Faible'
              ELSE 'Non renseigné' END AS etat_batterie,
         CASE WHEN g.city IN ('NATION_0','NATION_5','NATION_10') THEN 'Urbain' ELSE 'Péri-urbain' END AS zone_type
  FROM supplier LEFT JOIN geo g ON s_nationkey = g.n_nationkey),
towers_s AS (
  SELECT tower_id, tower_name, city, region, country,
         CASE WHEN latitude BETWEEN -90 AND 90 THEN latitude END AS latitude,
         CASE WHEN longitude BETWEEN -180 AND 180 THEN longitude END AS longitude,
         CASE WHEN capacity_users < 0 THEN 0 ELSE capacity_users END AS capacity_users,
         technology, installation_date, status, etat_batterie, zone_type, k
  FROM towers_raw),
locations_s AS (
  SELECT city, country, region, latitude, longitude, zone_type,
         CASE WHEN city IN ('NATION_0','NATION_1') THEN 'Grande ville'
              WHEN city IN ('NATION_2','NATION_3') THEN 'Ville moyenne' ELSE 'Petite ville' END AS population_zone
  FROM (SELECT *, row_number() OVER (PARTITION BY city, country ORDER BY tower_id) AS rn FROM towers_s) x
  WHERE rn = 1),
life AS (
  SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
  FROM orders GROUP BY o_custkey),
subs_base AS (
  SELECT c.c_custkey AS k, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, g.city, g.country,
         coalesce(l.first_order, TIMESTAMP '1994-06-01') AS first_order,
         coalesce(l.last_order, TIMESTAMP '1994-06-01') AS last_order,
         coalesce(l.last_order, TIMESTAMP '1994-06-01') < TIMESTAMP '2000-01-01' AS churned
  FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey
  LEFT JOIN life l ON c.c_custkey = l.o_custkey),
subs_typed AS (
  SELECT k,
         CASE WHEN k % 499 = 498 THEN NULL ELSE 'SUB' || CAST(k AS VARCHAR) END AS subscriber_id,
         c_name AS first_name, 'Famille' || CAST(c_nationkey AS VARCHAR) AS last_name,
         CASE WHEN k % 7 < 3 THEN 'M' WHEN k % 7 < 6 THEN 'F' WHEN k % 3 = 0 THEN 'M'
              ELSE 'Inconnu' END AS gender,
         CASE WHEN k % 41 = 0 OR k % 43 = 0 OR k % 47 = 0 THEN NULL
              ELSE CAST(14 + (k * 13) % 75 AS INTEGER) END AS age,
         city, country,
         CASE WHEN k % 503 = 502 THEN NULL ELSE 'P' || CAST(k % n_plans AS VARCHAR) END AS plan_id,
         'T' || CAST(k % n_towers AS VARCHAR) AS tower_id,
         CAST(first_order AS DATE) AS subscription_date,
         '+226' || lpad(CAST(k AS VARCHAR), 8, '0') AS phone_number,
         CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN 'user' || CAST(k AS VARCHAR) || '@mail.c'
              ELSE 'user' || CAST(k AS VARCHAR) || '@mail.com' END AS email_raw,
         CAST(CASE WHEN k % 53 = 0 THEN 0 WHEN churned THEN 1 ELSE 0 END AS INTEGER) AS churn,
         CASE WHEN churned AND k % 5 <> 0 THEN CAST(last_order AS DATE) + 30
              WHEN NOT churned AND k % 11 = 0 THEN CAST(last_order AS DATE) END AS churn_date_raw,
         CASE WHEN k % 37 = 0 THEN NULL
              ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) END AS rev_raw,
         c_mktsegment AS segment
  FROM subs_base, counts),
subs_s AS (
  SELECT t.k, subscriber_id, first_name, last_name, first_name || ' ' || last_name AS nom_complet,
         gender, age,
         CASE WHEN age IS NULL THEN 'Inconnu' WHEN age < 25 THEN '16-24' WHEN age < 35 THEN '25-34'
              WHEN age < 50 THEN '35-49' ELSE '50+' END AS tranche_age,
         city, country, plan_id, tower_id, subscription_date, phone_number,
         CASE WHEN email_raw LIKE '%_@_%.__%' THEN email_raw END AS email,
         segment, churn,
         CASE WHEN churn = 0 THEN NULL WHEN churn_date_raw IS NULL THEN DATE '{AS_OF}'
              ELSE churn_date_raw END AS churn_date,
         CAST(coalesce(rev_raw, m.med) AS DECIMAL(10,2)) AS monthly_revenue
  FROM subs_typed t, (SELECT median(rev_raw) AS med FROM subs_typed) m
  WHERE subscriber_id IS NOT NULL AND plan_id IS NOT NULL
    AND city IS NOT NULL AND country IS NOT NULL),
subs_d AS (
  SELECT *,
         CAST((year(coalesce(churn_date, DATE '{AS_OF}')) - year(subscription_date)) * 12
              + (month(coalesce(churn_date, DATE '{AS_OF}')) - month(subscription_date))
              - CASE WHEN day(coalesce(churn_date, DATE '{AS_OF}')) < day(subscription_date) THEN 1 ELSE 0 END
              AS INTEGER) AS anciennete_mois
  FROM subs_s),
usage_typed AS (
  SELECT 'U' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
             || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-'
             || strftime(l_shipdate, '%Y%m%d') || '-' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS usage_id,
         l_orderkey, l_linenumber,
         'SUB' || CAST(o_custkey AS VARCHAR) AS subscriber_id,
         'T' || CAST(l_suppkey AS VARCHAR) AS tower_id,
         CASE WHEN l_returnflag = 'A' AND l_linenumber % 2 = 1 THEN 'Appel_Sortant'
              WHEN l_returnflag = 'A' THEN 'Appel_Entrant'
              WHEN l_returnflag = 'N' AND l_linenumber % 2 = 1 THEN 'SMS_Sortant'
              WHEN l_returnflag = 'N' THEN 'SMS_Entrant' ELSE 'Data' END AS event_type,
         CASE WHEN (l_orderkey + l_linenumber) % 1009 = 0 THEN NULL
              ELSE l_shipdate + to_hours(CAST((l_orderkey + l_linenumber) % 24 AS BIGINT)) END AS event_datetime,
         CAST(CASE WHEN l_returnflag = 'A' AND l_orderkey % 211 = 0 THEN -5
                   WHEN l_returnflag = 'A' THEN CAST(l_quantity * 60 AS INTEGER) ELSE 0 END AS INTEGER) AS duration_sec,
         CASE WHEN l_returnflag = 'R' AND l_orderkey % 223 = 0 THEN 0.0
              WHEN l_returnflag = 'R' AND l_orderkey % 227 = 0 THEN -1.0
              WHEN l_returnflag = 'R' AND l_orderkey % 229 = 0 THEN 1e12
              WHEN l_returnflag = 'R' THEN CAST(CAST(l_extendedprice / 100 AS DECIMAL(12,4)) AS DOUBLE)
              ELSE 0.0 END AS data_mb,
         CASE WHEN (l_orderkey * 3 + l_linenumber) % 100 IN (0, 1) THEN NULL
              WHEN (l_orderkey + l_partkey) % 401 = 0 THEN -3.0
              WHEN (l_orderkey + l_partkey) % 409 = 5 THEN 1e12
              ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                             AS DECIMAL(12,2)) AS DOUBLE) END AS amount_raw,
         CASE WHEN l_linestatus = 'F' THEN 'Succès' WHEN l_linenumber % 3 = 0 THEN 'Interrompu'
              ELSE 'Échec' END AS status,
         CASE l_linenumber % 3 WHEN 0 THEN '2G' WHEN 1 THEN '3G' ELSE '4G' END AS network_type,
         CAST(CASE WHEN l_tax > 0.06 THEN 1 ELSE 0 END AS INTEGER) AS roaming
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
usage_imp AS (
  SELECT *, coalesce(amount_raw, median(amount_raw) OVER (PARTITION BY event_type)) AS amount_imp
  FROM usage_typed),
usage_clean AS (
  SELECT * FROM usage_imp
  WHERE subscriber_id IN (SELECT subscriber_id FROM subs_s)
    AND tower_id IN (SELECT tower_id FROM towers_s)
    AND event_datetime IS NOT NULL),
usage_s AS (
  SELECT usage_id, subscriber_id, tower_id, event_type, event_datetime,
         CASE WHEN duration_sec < 0 THEN 0 ELSE duration_sec END AS duration_sec,
         CASE WHEN data_mb < 0 THEN 0.0 WHEN data_mb < 1e8 THEN data_mb END AS data_mb,
         CASE WHEN amount_imp >= 0 AND amount_imp < 1e10 THEN amount_imp END AS amount,
         data_mb >= 1e8 OR coalesce(amount_imp >= 1e10, FALSE) AS out_of_range,
         data_mb AS data_mb_raw,
         status, network_type, roaming
  FROM usage_clean),
fact_u AS (
  SELECT u.usage_id, u.subscriber_id, u.tower_id, s.plan_id, u.event_type, u.event_datetime,
         CAST(u.event_datetime AS DATE) AS event_date,
         CAST(strftime(u.event_datetime, '%Y%m%d') AS INTEGER) AS date_sk,
         hour(u.event_datetime) AS event_hour,
         u.duration_sec, CAST(u.data_mb AS DECIMAL(12,4)) AS data_mb,
         CAST(CAST(u.data_mb AS DECIMAL(12,4)) * CAST(0.0009765625 AS DECIMAL(11,10)) AS DECIMAL(12,6)) AS data_gb,
         CAST(u.amount AS DECIMAL(12,2)) AS amount_fcfa,
         u.status, u.network_type, u.roaming,
         s.country AS sub_country, s.city AS sub_city, s.segment,
         t.city AS tower_city, t.country AS tower_country, t.technology
  FROM usage_s u JOIN subs_s s ON u.subscriber_id = s.subscriber_id
  JOIN towers_s t ON u.tower_id = t.tower_id),
inc_typed AS (
  SELECT 'INC' || CAST(o_orderkey AS VARCHAR) AS incident_id, o_orderkey,
         CASE WHEN o_orderkey % 307 = 0 THEN 'T999999999'
              ELSE 'T' || CAST(o_orderkey % n_towers AS VARCHAR) END AS tower_id,
         CASE o_orderkey % 6 WHEN 0 THEN 'Coupure réseau' WHEN 1 THEN 'Congestion'
              WHEN 2 THEN 'Panne électrique' WHEN 3 THEN 'Interférence' WHEN 4 THEN 'Maintenance'
              ELSE 'Vandalisme' END AS incident_type,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'Élevé'
              WHEN o_orderpriority LIKE '2%' OR o_orderpriority LIKE '3%' THEN 'Moyen'
              ELSE 'Faible' END AS severity,
         CASE WHEN o_orderkey % 401 = 7 THEN NULL
              ELSE o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) END AS incident_datetime,
         CAST(CASE WHEN o_orderkey % 53 = 0 THEN 12 ELSE 5 + o_orderkey % 240 END AS INTEGER) AS minutes_raw,
         CAST(CASE WHEN o_orderkey % 19 = 0 THEN 1 WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END AS INTEGER) AS resolved,
         CASE WHEN o_orderkey % 20 = 0 THEN 'Non renseigné'
              ELSE 'Incident ' || CAST(o_orderkey AS VARCHAR) END AS description,
         CAST(CASE WHEN o_orderkey % 61 = 0 THEN -2 ELSE o_custkey % 500 END AS INTEGER) AS affected_raw
  FROM orders, counts),
inc_clean AS (
  SELECT * FROM inc_typed
  WHERE tower_id IN (SELECT tower_id FROM towers_s) AND incident_datetime IS NOT NULL),
fact_i AS (
  SELECT i.incident_id, i.tower_id, i.incident_type, i.severity, i.incident_datetime,
         CAST(i.incident_datetime AS DATE) AS event_date,
         CAST(strftime(i.incident_datetime, '%Y%m%d') AS INTEGER) AS date_sk,
         CASE WHEN i.resolved = 0 THEN NULL ELSE i.minutes_raw END AS resolution_minutes,
         i.resolved, i.description,
         CASE WHEN i.affected_raw < 0 THEN 0 ELSE i.affected_raw END AS nb_abonnes_affectes,
         t.tower_name, t.city, t.country, t.technology
  FROM inc_clean i JOIN towers_s t ON i.tower_id = t.tower_id)
"""


AS_OF2 = "2002-01-01"
GAP_START, GAP_END = "1996-01-01", "2000-12-31"
PIT_START, PIT_CHANGE = "1992-01-01", "1998-01-01"
MONTHS = list(CFG.snapshot_months)


def _delta_subscriber_ctes() -> str:
    """Second-day subscriber feed: the same cleaning, with the delta rules."""
    a = BASE.index("subs_typed AS (")
    b = BASE.index("usage_typed AS (")
    blk = BASE[a:b]
    blk = blk.replace("subs_typed", "subs_typed2").replace("subs_s AS", "subs_s2 AS")
    blk = blk.replace("subs_d AS", "subs_d2 AS").replace("FROM subs_s)", "FROM subs_s2)")
    blk = blk.replace("c_mktsegment AS segment",
                      "CASE WHEN k % 7 = 0 AND c_mktsegment = 'BUILDING' THEN 'MACHINERY' "
                      "WHEN k % 7 = 0 THEN 'BUILDING' ELSE c_mktsegment END AS segment")
    blk = blk.replace("ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) END AS rev_raw",
                      "ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) + CASE WHEN k % 7 = 1 THEN 100 ELSE 0 END "
                      "AS DOUBLE) END AS rev_raw")
    blk = blk.replace("CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1",
                      "CASE WHEN k % 7 = 2 THEN 'new' || CAST(k AS VARCHAR) || '@mail.com' "
                      "WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1")
    # tenure of the second run ends at its own date
    blk = blk.replace(f"coalesce(churn_date, DATE '{AS_OF}')", f"coalesce(churn_date, DATE '{AS_OF2}')")
    return blk


BASE = BASE.rstrip() + ",\n" + _delta_subscriber_ctes().rstrip().rstrip(",") + "\n"

def with_base(select: str) -> str:
    return "WITH " + BASE.strip() + "\n" + select.strip()


def month_cols(d: str) -> str:
    return (f"CAST(year({d}) AS INTEGER) AS annee, CAST(month({d}) AS INTEGER) AS mois, "
            f"{MONTHS_FR}[month({d})] AS nom_mois, "
            f"CAST(year({d}) AS VARCHAR) || '-Q' || CAST(quarter({d}) AS VARCHAR) AS annee_trimestre")


def hu(num: str, den: str, digits: int, num_scale: int = 0, mult: int = 1, div: int = 1) -> str:
    """round_half_up(num * mult / (den * div), digits) in exact integer arithmetic."""
    n = f"(CAST(({num}) * {10 ** num_scale} AS BIGINT) * {mult})"
    d = f"(CAST(({den}) AS BIGINT) * {10 ** num_scale * div})"
    p = 10 ** digits
    a = f"({n} * {2 * p} + {d})"
    b = f"({d} * 2)"
    return f"(CASE WHEN {d} <> 0 THEN CAST(({a} - {a} % {b}) // {b} AS DOUBLE) / {float(p)} END)"


def half_even(num: str, den: str, digits: int) -> str:
    """num / den rounded to ``digits``, ties to the even digit, by remainder."""
    n, d = f"(CAST(({num}) AS HUGEINT) * {10 ** digits})", f"CAST(({den}) AS HUGEINT)"
    up = f"2 * ({n} % {d}) > {d} OR (2 * ({n} % {d}) = {d} AND ({n} // {d}) % 2 = 1)"
    return f"(CASE WHEN {d} <> 0 THEN CAST({n} // {d} + CASE WHEN {up} THEN 1 ELSE 0 END AS DOUBLE) / {float(10 ** digits)} END)"


IN_CAL = "IS NOT NULL"  # the calendar spans all dates of the feeds
KPI_BODY: dict[str, str] = {}


def _kpi(name: str, body: str) -> str:
    KPI_BODY[name] = body
    return with_base(body)

FAILED = "SUM(CASE WHEN status = 'Échec' THEN 1 ELSE 0 END)"

SQL: dict[str, str] = {}

SQL["kpi_churn_mensuel"] = _kpi("kpi_churn_mensuel", f"""
SELECT {month_cols('d')}, country, city, segment, plan_name, type_abonnement,
       CAST(COUNT(DISTINCT subscriber_id) AS BIGINT) AS total_abonnes,
       CAST(SUM(churn) AS BIGINT) AS nb_churnes,
       {hu('SUM(churn)', 'COUNT(DISTINCT subscriber_id)', 2, mult=100)} AS taux_churn_pct
FROM (SELECT s.*, p.plan_name, p.type_abonnement, coalesce(s.churn_date, DATE '{AS_OF}') AS d
      FROM subs_s s JOIN plans_s p ON s.plan_id = p.plan_id) x
WHERE d {IN_CAL}
GROUP BY ALL
""")

SQL["kpi_arpu"] = _kpi("kpi_arpu", f"""
SELECT {month_cols('event_date')}, u.sub_country AS country, u.sub_city AS city,
       p.plan_name, p.type_abonnement,
       CAST(COUNT(DISTINCT u.subscriber_id) AS BIGINT) AS nb_abonnes_actifs,
       CAST(ROUND(SUM(u.amount_fcfa), 2) AS DOUBLE) AS revenu_total,
       {hu('SUM(u.amount_fcfa)', 'COUNT(u.amount_fcfa)', 2, num_scale=2)} AS revenu_moyen_par_evenement,
       {hu('SUM(u.amount_fcfa)', 'COUNT(DISTINCT u.subscriber_id)', 2, num_scale=2)} AS arpu
FROM fact_u u JOIN plans_s p ON u.plan_id = p.plan_id
WHERE u.amount_fcfa IS NOT NULL AND u.event_date {IN_CAL}
GROUP BY ALL
""")

SQL["kpi_utilisation_reseau"] = _kpi("kpi_utilisation_reseau", f"""
SELECT CAST(year(event_date) AS INTEGER) AS annee, CAST(month(event_date) AS INTEGER) AS mois,
       {MONTHS_FR}[month(event_date)] AS nom_mois,
       u.tower_id, t.tower_name, t.city, t.country, t.technology, t.capacity_users,
       CAST(COUNT(DISTINCT u.subscriber_id) AS BIGINT) AS abonnes_actifs,
       CAST(COUNT(*) AS BIGINT) AS nb_evenements,
       {hu('COUNT(DISTINCT u.subscriber_id)', 't.capacity_users', 2, mult=100)} AS taux_utilisation_pct,
       {hu('SUM(u.data_mb)', '1', 2, num_scale=4, div=1024)} AS volume_data_gb,
       {hu('SUM(u.duration_sec)', '1', 2, div=3600)} AS volume_appels_heures
FROM fact_u u JOIN towers_s t ON u.tower_id = t.tower_id
WHERE u.event_date {IN_CAL}
GROUP BY year(event_date), month(event_date), u.tower_id, t.tower_name, t.city, t.country,
         t.technology, t.capacity_users
""")

SQL["kpi_incidents_qualite"] = _kpi("kpi_incidents_qualite", f"""
SELECT CAST(year(event_date) AS INTEGER) AS annee, CAST(month(event_date) AS INTEGER) AS mois,
       {MONTHS_FR}[month(event_date)] AS nom_mois,
       tower_id, tower_name, city, country, technology,
       CAST(COUNT(*) AS BIGINT) AS nb_incidents,
       CAST(SUM(CASE WHEN severity = 'Élevé' THEN 1 ELSE 0 END) AS BIGINT) AS incidents_eleves,
       CAST(SUM(CASE WHEN severity = 'Moyen' THEN 1 ELSE 0 END) AS BIGINT) AS incidents_moyens,
       CAST(SUM(nb_abonnes_affectes) AS BIGINT) AS total_abonnes_affectes,
       {hu('SUM(resolution_minutes)', 'COUNT(resolution_minutes)', 1)} AS duree_resolution_moy_min,
       {hu('SUM(resolved)', 'COUNT(*)', 2, mult=100)} AS taux_resolution_pct
FROM fact_i
WHERE event_date {IN_CAL}
GROUP BY ALL
""")

SQL["kpi_duree_appels"] = _kpi("kpi_duree_appels", f"""
SELECT {month_cols('event_date')}, CAST(NULL AS VARCHAR) AS tranche_horaire,
       sub_country AS country, sub_city AS city, segment, network_type,
       CAST(COUNT(*) AS BIGINT) AS nb_appels,
       {hu('SUM(duration_sec)', 'COUNT(duration_sec)', 1)} AS duree_moy_sec,
       {hu('SUM(duration_sec)', 'COUNT(duration_sec)', 2, div=60)} AS duree_moy_min,
       {hu('SUM(duration_sec)', '1', 2, div=3600)} AS volume_total_heures,
       CAST({FAILED} AS BIGINT) AS nb_appels_echoues,
       {hu(FAILED, 'COUNT(*)', 2, mult=100)} AS taux_echec_pct
FROM fact_u
WHERE event_type IN ('Appel_Sortant', 'Appel_Entrant') AND event_date {IN_CAL}
GROUP BY ALL
""")

RETAINED = "SUM(CASE WHEN s.churn = 0 THEN 1 ELSE 0 END)"
SQL["kpi_retention_par_offre"] = _kpi("kpi_retention_par_offre", f"""
SELECT p.plan_name, p.type_abonnement, p.country, CAST(p.monthly_fee AS DOUBLE) AS monthly_fee,
       CAST(COUNT(DISTINCT s.subscriber_id) AS BIGINT) AS total_abonnes,
       CAST({RETAINED} AS BIGINT) AS abonnes_retenus,
       CAST(SUM(s.churn) AS BIGINT) AS abonnes_perdus,
       {hu(RETAINED, 'COUNT(*)', 2, mult=100)} AS taux_retention_pct,
       {hu('SUM(s.churn)', 'COUNT(*)', 2, mult=100)} AS taux_churn_pct,
       {hu('SUM(s.anciennete_mois)', 'COUNT(s.anciennete_mois)', 1)} AS anciennete_moy_mois
FROM subs_d s JOIN plans_s p ON s.plan_id = p.plan_id
GROUP BY p.plan_name, p.type_abonnement, p.country, p.monthly_fee
""")

SQL["kpi_data_par_region"] = _kpi("kpi_data_par_region", f"""
SELECT {month_cols('u.event_date')}, l.country, l.city, l.region, u.technology,
       CAST(COUNT(DISTINCT u.subscriber_id) AS BIGINT) AS abonnes_data,
       CAST(COUNT(*) AS BIGINT) AS nb_sessions_data,
       CAST(ROUND(SUM(u.data_mb), 2) AS DOUBLE) AS total_mb,
       CAST(ROUND(SUM(u.data_gb), 4) AS DOUBLE) AS total_gb,
       {hu('SUM(u.data_mb)', 'COUNT(u.data_mb)', 2, num_scale=4)} AS data_moy_par_session_mb,
       CAST(ROUND(SUM(u.amount_fcfa), 2) AS DOUBLE) AS revenu_data_total
FROM fact_u u JOIN locations_s l ON u.tower_city = l.city AND u.tower_country = l.country
WHERE u.event_type = 'Data' AND u.event_date {IN_CAL}
GROUP BY ALL
""")


# ------------------------------------------------------------------ cleaning
SUB_COLS = ("subscriber_id, first_name, last_name, gender, age, tranche_age, city, country, plan_id, "
            "tower_id, subscription_date, phone_number")

SQL["clean_plans"] = with_base("""
SELECT plan_id, plan_name, country, CAST(monthly_fee AS DOUBLE) AS monthly_fee,
       CAST(data_quota_gb AS DOUBLE) AS data_quota_gb, call_minutes, sms_quota, type_abonnement,
       categorie_prix
FROM plans_s
""")

SQL["clean_towers"] = with_base("""
SELECT tower_id, tower_name, city, region, country, latitude, longitude, capacity_users, technology,
       installation_date, status, etat_batterie, zone_type
FROM towers_raw
""")

SQL["clean_subscribers"] = with_base(f"""
SELECT {SUB_COLS}, email_raw AS email, churn, churn_date_raw AS churn_date,
       CAST(CAST(coalesce(rev_raw, m.med) AS DECIMAL(10,2)) AS DOUBLE) AS monthly_revenue, segment
FROM (SELECT *, CASE WHEN age IS NULL THEN 'Inconnu' WHEN age < 25 THEN '16-24' WHEN age < 35 THEN '25-34'
                     WHEN age < 50 THEN '35-49' ELSE '50+' END AS tranche_age FROM subs_typed) t,
     (SELECT median(rev_raw) AS med FROM subs_typed) m
WHERE subscriber_id IS NOT NULL AND plan_id IS NOT NULL
""")

SQL["clean_usage"] = with_base("""
SELECT usage_id, subscriber_id, tower_id, event_type, event_datetime, duration_sec, data_mb,
       amount_imp AS amount_fcfa, status, network_type, roaming
FROM usage_clean
""")

SQL["clean_incidents"] = with_base("""
SELECT incident_id, tower_id, incident_type, severity, incident_datetime,
       minutes_raw AS resolution_minutes, resolved, affected_raw AS nb_abonnes_affectes, description
FROM inc_clean
""")

SQL["impute_global_median"] = with_base("""
SELECT subscriber_id, CAST(CAST(coalesce(rev_raw, m.med) AS DECIMAL(10,2)) AS DOUBLE) AS monthly_revenue,
       CAST(rev_raw IS NULL AS INTEGER) AS revenue_imputed
FROM subs_typed t, (SELECT median(rev_raw) AS med FROM subs_typed) m
""")

SQL["impute_group_median"] = with_base("""
SELECT usage_id, event_type, CASE WHEN amount_imp < 1e10 THEN CAST(CAST(amount_imp AS DECIMAL(12,2)) AS DOUBLE) END AS amount_fcfa,
       CAST(amount_raw IS NULL AS INTEGER) AS amount_imputed
FROM usage_imp
""")

# ------------------------------------------------------------------- quality
SQL["dq_subscriber"] = with_base(f"""
SELECT {SUB_COLS}, email, churn, churn_date, CAST(monthly_revenue AS DOUBLE) AS monthly_revenue, segment
FROM subs_s
""")

SQL["dq_usage"] = with_base("""
SELECT usage_id, subscriber_id, tower_id, event_type, event_datetime, duration_sec, data_mb,
       amount AS amount_fcfa, status, network_type, roaming
FROM usage_s
""")

SQL["dq_incident"] = with_base("""
SELECT incident_id, tower_id, incident_type, severity, incident_datetime,
       CASE WHEN resolved = 0 THEN NULL ELSE minutes_raw END AS resolution_minutes, resolved,
       CASE WHEN affected_raw < 0 THEN 0 ELSE affected_raw END AS nb_abonnes_affectes, description
FROM inc_clean
""")

SQL["dq_tower"] = with_base("""
SELECT tower_id, tower_name, city, region, country, latitude, longitude, capacity_users, technology,
       installation_date, status, etat_batterie, zone_type
FROM towers_s
""")

SQL["dq_quarantine"] = with_base("""
SELECT 'fact_usage' AS source_table, usage_id AS record_id,
       'Data event with data_mb = 0' AS rejection_reason
FROM usage_s WHERE event_type = 'Data' AND data_mb = 0
UNION ALL
SELECT 'fact_usage', usage_id, 'Valeur numérique hors limites' FROM usage_s WHERE out_of_range
""")

SQL["dq_report"] = with_base(f"""
SELECT 'dim_subscriber' AS table_name, CAST(COUNT(*) AS BIGINT) AS total_lignes,
       CAST(SUM(CASE WHEN age IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS age_manquant,
       CAST(SUM(CASE WHEN email IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS email_manquant,
       CAST(SUM(CASE WHEN gender = 'Inconnu' THEN 1 ELSE 0 END) AS BIGINT) AS genre_inconnu,
       {hu("COUNT(*) * 2 - SUM(CASE WHEN age IS NULL THEN 1 ELSE 0 END) - SUM(CASE WHEN email IS NULL THEN 1 ELSE 0 END)", "COUNT(*) * 2", 2, mult=100)} AS score_completude_pct
FROM subs_s
UNION ALL
SELECT 'fact_usage', CAST(COUNT(*) AS BIGINT), CAST(SUM(CASE WHEN amount_fcfa IS NULL THEN 1 ELSE 0 END) AS BIGINT),
       NULL, NULL,
       {hu("COUNT(*) - SUM(CASE WHEN amount_fcfa IS NULL THEN 1 ELSE 0 END)", "COUNT(*)", 2, mult=100)}
FROM fact_u
UNION ALL
SELECT 'fact_incident', CAST(COUNT(*) AS BIGINT),
       CAST(SUM(CASE WHEN resolution_minutes IS NULL THEN 1 ELSE 0 END) AS BIGINT), NULL, NULL,
       {hu("COUNT(*) - SUM(CASE WHEN resolution_minutes IS NULL THEN 1 ELSE 0 END)", "COUNT(*)", 2, mult=100)}
FROM fact_i
""")

SQL["dq_calendar_gaps"] = with_base(f"""
SELECT DISTINCT 'incidents' AS source, CAST(incident_datetime AS DATE) AS date_complete
FROM inc_typed
WHERE incident_datetime IS NOT NULL
  AND CAST(incident_datetime AS DATE) NOT BETWEEN DATE '{GAP_START}' AND DATE '{GAP_END}'
UNION ALL
SELECT DISTINCT 'subscribers', subscription_date
FROM subs_typed
WHERE subscription_date NOT BETWEEN DATE '{GAP_START}' AND DATE '{GAP_END}'
""")

# ------------------------------------------------------------------ calendar
DAYS_FR = "['Lundi','Mardi','Mercredi','Jeudi','Vendredi','Samedi','Dimanche']"
HOLIDAYS = "('01-01','03-08','05-01','08-05','03-06','12-25')"


def calendar_a(start: str, end: str) -> str:
    return f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS date_complete,
       CAST(day(d) AS INTEGER) AS jour, CAST(isodow(d) AS INTEGER) AS jour_semaine,
       {DAYS_FR}[isodow(d)] AS nom_jour, CAST(weekofyear(d) AS INTEGER) AS semaine_annee,
       CAST(month(d) AS INTEGER) AS mois, {MONTHS_FR}[month(d)] AS nom_mois,
       CAST(quarter(d) AS INTEGER) AS trimestre, CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre,
       CAST(year(d) AS INTEGER) AS annee,
       CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN isodow(d) >= 6 OR strftime(d, '%m-%d') IN {HOLIDAYS} THEN 0 ELSE 1 END AS is_jour_ouvre,
       CASE WHEN strftime(d, '%m-%d') IN {HOLIDAYS} THEN 1 ELSE 0 END AS is_ferie,
       CASE WHEN month(d) BETWEEN 6 AND 9 THEN 'Hivernage' ELSE 'Saison sèche' END AS saison,
       'FY' || CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS periode_fiscale,
       strftime(d, '%Y-%m') AS mois_annee,
       CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS annee_trimestre,
       CAST(NULL AS INTEGER) AS heure, CAST(NULL AS VARCHAR) AS tranche_horaire
FROM (SELECT CAST(generate_series AS DATE) AS d
      FROM generate_series({start}, {end}, INTERVAL 1 DAY)) g
"""


def calendar_b(start: str, end: str) -> str:
    return f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS date_complete,
       CAST(day(d) AS INTEGER) AS jour, CAST(dayofweek(d) + 1 AS INTEGER) AS jour_semaine,
       dayname(d) AS nom_jour,
       CAST(CASE WHEN month(d) = 1 AND weekofyear(d) >= 52 THEN 0
                 WHEN month(d) = 12 AND weekofyear(d) = 1 THEN 53 ELSE weekofyear(d) END AS INTEGER) AS semaine_annee,
       CAST(month(d) AS INTEGER) AS mois, monthname(d) AS nom_mois,
       CAST(quarter(d) AS INTEGER) AS trimestre, CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre,
       CAST(year(d) AS INTEGER) AS annee,
       CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN dayofweek(d) IN (0, 6) THEN 0 ELSE 1 END AS is_jour_ouvre,
       0 AS is_ferie,
       CASE WHEN month(d) BETWEEN 6 AND 10 THEN 'Hivernage' ELSE 'Saison sèche' END AS saison,
       'FY' || CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS periode_fiscale,
       strftime(d, '%Y-%m') AS mois_annee,
       CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS annee_trimestre,
       CAST(NULL AS INTEGER) AS heure, CAST(NULL AS VARCHAR) AS tranche_horaire
FROM (SELECT CAST(generate_series AS DATE) AS d
      FROM generate_series({start}, {end}, INTERVAL 1 DAY)) g
"""


# the calendar covers the whole years of all dates of the feeds and of the run
SPAN = f"""
all_days AS (
  SELECT CAST(event_datetime AS DATE) AS d FROM usage_typed UNION ALL SELECT CAST(incident_datetime AS DATE) FROM inc_typed
  UNION ALL SELECT subscription_date FROM subs_typed UNION ALL SELECT churn_date_raw FROM subs_typed UNION ALL SELECT DATE '{AS_OF}')"""
CAL_START, CAL_END = ("(SELECT CAST(make_date(year(min(d)), 1, 1) AS TIMESTAMP) FROM all_days)",
                      "(SELECT CAST(make_date(year(max(d)), 12, 31) AS TIMESTAMP) FROM all_days)")
GAP_S, GAP_E = f"TIMESTAMP '{GAP_START}'", f"TIMESTAMP '{GAP_END}'"


def spanned(select: str) -> str:
    return "WITH " + BASE.strip() + ",\n" + SPAN.strip() + "\n" + select.strip()


SQL["dim_calendar_a"] = spanned(calendar_a(CAL_START, CAL_END))
SQL["dim_calendar_b"] = spanned(f"""
SELECT * FROM ({calendar_a(GAP_S, GAP_E)}) a
UNION ALL
SELECT * FROM ({calendar_b(CAL_START, CAL_END)}) b
WHERE b.date_complete NOT BETWEEN DATE '{GAP_START}' AND DATE '{GAP_END}'
""")
SQL["dq_calendar_checks"] = spanned(f"""
SELECT min(date_complete) AS premiere_date, max(date_complete) AS derniere_date,
       CAST(count(*) AS BIGINT) AS nb_jours_total,
       CAST(date_diff('day', min(date_complete), max(date_complete)) + 1 AS BIGINT) AS jours_attendus,
       CAST(sum(is_weekend) AS BIGINT) AS nb_weekends, CAST(sum(is_ferie) AS BIGINT) AS nb_feries
FROM ({calendar_a(CAL_START, CAL_END)}) c
""")

# ---------------------------------------------------------------- dimensions
SQL["dim_location"] = with_base("""
SELECT city, region, country, 'Afrique de l''Ouest' AS continent,
       CAST(CAST(latitude AS DECIMAL(9,6)) AS DOUBLE) AS latitude,
       CAST(CAST(longitude AS DECIMAL(9,6)) AS DOUBLE) AS longitude,
       zone_type, population_zone,
       CASE WHEN country = 'Burkina Faso' THEN 'Africa/Ouagadougou' ELSE 'Africa/Accra' END AS fuseau_horaire
FROM locations_s
""")

DIM_SUB_COLS = ("subscriber_id, first_name, last_name, nom_complet, gender, age, tranche_age, city, country, "
                "plan_id, tower_id, phone_number, email, segment, churn, churn_date, subscription_date")
SCD_SUB = f"""
v1 AS (SELECT * FROM subs_d),
v2 AS (SELECT * FROM subs_d2),
cls AS (
  SELECT v1.subscriber_id,
         CASE WHEN v2.subscriber_id IS NULL THEN 'absent'
              WHEN v1.city IS DISTINCT FROM v2.city OR v1.segment IS DISTINCT FROM v2.segment
                   OR v1.plan_id IS DISTINCT FROM v2.plan_id THEN 'changed'
              WHEN v1.churn IS DISTINCT FROM v2.churn OR v1.churn_date IS DISTINCT FROM v2.churn_date
                   OR v1.monthly_revenue IS DISTINCT FROM v2.monthly_revenue
                   OR v1.phone_number IS DISTINCT FROM v2.phone_number
                   OR v1.email IS DISTINCT FROM v2.email THEN 'minor'
              ELSE 'same' END AS kind
  FROM v1 LEFT JOIN v2 ON v1.subscriber_id = v2.subscriber_id),
merged AS (
  SELECT {DIM_SUB_COLS.replace('churn, churn_date', 'v1.churn, v1.churn_date')
          .replace('subscriber_id,', 'v1.subscriber_id,', 1).replace('phone_number, email', 'v1.phone_number, v1.email')},
         v1.monthly_revenue, v1.anciennete_mois,
         DATE '{AS_OF}' AS date_debut, CAST(NULL AS DATE) AS date_fin, 1 AS is_current, 1 AS version
  FROM v1 JOIN cls c ON v1.subscriber_id = c.subscriber_id WHERE c.kind IN ('same', 'absent')
  UNION ALL
  SELECT {DIM_SUB_COLS.replace('subscriber_id,', 'v1.subscriber_id,', 1).replace('churn, churn_date', 'v1.churn, v1.churn_date').replace('phone_number, email', 'v1.phone_number, v1.email')},
         v1.monthly_revenue, v1.anciennete_mois,
         DATE '{AS_OF}', DATE '{AS_OF2}', 0, 1
  FROM v1 JOIN cls c ON v1.subscriber_id = c.subscriber_id WHERE c.kind = 'changed'
  UNION ALL
  SELECT {DIM_SUB_COLS.replace('subscriber_id,', 'v2.subscriber_id,', 1)},
         v2.monthly_revenue, v2.anciennete_mois,
         DATE '{AS_OF2}', CAST(NULL AS DATE), 1, 2
  FROM v2 JOIN cls c ON v2.subscriber_id = c.subscriber_id WHERE c.kind = 'changed'
  UNION ALL
  SELECT v1.subscriber_id, v1.first_name, v1.last_name, v1.nom_complet, v1.gender, v1.age, v1.tranche_age,
         v1.city, v1.country, v1.plan_id, v1.tower_id, v2.phone_number, v2.email, v1.segment,
         v2.churn, v2.churn_date, v1.subscription_date, v2.monthly_revenue, v1.anciennete_mois,
         DATE '{AS_OF}', CAST(NULL AS DATE), 1, 1
  FROM v1 JOIN v2 ON v1.subscriber_id = v2.subscriber_id
  JOIN cls c ON v1.subscriber_id = c.subscriber_id WHERE c.kind = 'minor')
"""


def with_ctes(extra: str, select: str) -> str:
    return "WITH " + BASE.strip() + ",\n" + extra.strip() + "\n" + select.strip()


SQL["scd2_subscriber"] = with_ctes(SCD_SUB, """
SELECT subscriber_id, first_name, last_name, nom_complet, gender, age, tranche_age, city, country,
       plan_id, tower_id, phone_number, email, segment, churn, churn_date, subscription_date,
       CAST(monthly_revenue AS DOUBLE) AS monthly_revenue, anciennete_mois, date_debut, date_fin,
       is_current, version
FROM merged
""")

SQL["scd_changes"] = with_ctes(SCD_SUB, """
SELECT kind AS change_type, CAST(count(*) AS BIGINT) AS nb FROM cls GROUP BY kind
""")

PLAN2 = """
p2 AS (
  SELECT plan_id, CASE WHEN k % 13 = 0 THEN plan_name || ' v2' ELSE plan_name END AS plan_name,
         country, CAST(CASE WHEN k % 11 = 0 THEN monthly_fee + 5 ELSE monthly_fee END AS DECIMAL(10,2)) AS monthly_fee,
         data_quota_gb, call_minutes, sms_quota, type_abonnement, k
  FROM (SELECT *, CAST(substr(plan_id, 2) AS BIGINT) AS k FROM plans_s) x),
p2c AS (
  SELECT *, CASE WHEN monthly_fee < (CASE country WHEN 'AFRICA' THEN 930.0 WHEN 'EUROPE' THEN 920.0 ELSE 950.0 END)
                 THEN 'Économique'
                 WHEN monthly_fee < (CASE country WHEN 'AFRICA' THEN 970.0 WHEN 'EUROPE' THEN 980.0 ELSE 990.0 END)
                 THEN 'Standard' ELSE 'Premium' END AS categorie_prix
  FROM p2),
plan_hist AS (
  SELECT p.plan_id, p.plan_name, p.type_abonnement, p.country, p.monthly_fee, p.data_quota_gb,
         p.call_minutes, p.sms_quota, p.categorie_prix,
         DATE '{d1}' AS date_debut,
         CASE WHEN p.monthly_fee IS DISTINCT FROM q.monthly_fee THEN DATE '{d2}' END AS date_fin,
         CASE WHEN p.monthly_fee IS DISTINCT FROM q.monthly_fee THEN 0 ELSE 1 END AS is_current, 1 AS version
  FROM plans_s p JOIN p2c q ON p.plan_id = q.plan_id
  UNION ALL
  SELECT q.plan_id, q.plan_name, q.type_abonnement, q.country, q.monthly_fee, q.data_quota_gb,
         q.call_minutes, q.sms_quota, q.categorie_prix, DATE '{d2}', CAST(NULL AS DATE), 1, 2
  FROM plans_s p JOIN p2c q ON p.plan_id = q.plan_id
  WHERE p.monthly_fee IS DISTINCT FROM q.monthly_fee)
"""

SQL["scd2_plan"] = with_ctes(PLAN2.format(d1=AS_OF, d2=AS_OF2), """
SELECT plan_id, plan_name, type_abonnement, country, CAST(monthly_fee AS DOUBLE) AS monthly_fee,
       CAST(data_quota_gb AS DOUBLE) AS data_quota_gb, call_minutes, sms_quota, categorie_prix,
       date_debut, date_fin, is_current, version
FROM plan_hist
""")

SQL["scd1_tower"] = with_base("""
SELECT tower_id, tower_name, city, region, country,
       CAST(CAST(latitude AS DECIMAL(9,6)) AS DOUBLE) AS latitude,
       CAST(CAST(longitude AS DECIMAL(9,6)) AS DOUBLE) AS longitude,
       capacity_users, technology, installation_date,
       CASE WHEN k % 4 = 0 THEN 'Inactif' ELSE status END AS status, etat_batterie, zone_type
FROM towers_s
""")

SQL["guarded_delete"] = with_base("""
SELECT s.subscriber_id,
       CASE WHEN EXISTS (SELECT 1 FROM fact_u u WHERE u.subscriber_id = s.subscriber_id)
            THEN 'refused' ELSE 'deleted' END AS outcome
FROM subs_s s WHERE s.k % 97 = 0
""")

# --------------------------------------------------------------------- facts
SQL["fact_usage"] = with_base("""
SELECT date_sk, usage_id, CAST(event_hour AS INTEGER) AS event_hour, duration_sec,
       CAST(ROUND(CAST(duration_sec AS DOUBLE) / 60.0, 2) AS DOUBLE) AS duration_min,
       CAST(data_mb AS DOUBLE) AS data_mb, CAST(data_gb AS DOUBLE) AS data_gb,
       CAST(amount_fcfa AS DOUBLE) AS amount_fcfa, event_type, status, network_type, roaming,
       CAST(year(event_date) AS INTEGER) AS annee,
       CASE WHEN plan_id IN (SELECT plan_id FROM plans_s) THEN 1 ELSE 0 END AS has_plan
FROM fact_u
""")

SQL["fact_usage_rejects"] = with_base("""
SELECT u.usage_id, 'clé étrangère introuvable' AS rejection_reason
FROM fact_u u LEFT JOIN locations_s l ON u.tower_city = l.city AND u.sub_country = l.country
WHERE l.city IS NULL
""")

SQL["fact_incident"] = with_base("""
SELECT date_sk, incident_id, incident_type, severity, resolved, description, resolution_minutes,
       nb_abonnes_affectes, CAST(year(event_date) AS INTEGER) AS annee
FROM fact_i
""")

SQL["fact_append_idempotent"] = with_base("""
SELECT usage_id, date_sk FROM fact_u WHERE year(event_date) > 1998
""")

SQL["plan_point_in_time"] = with_ctes(PLAN2.format(d1=PIT_START, d2=PIT_CHANGE), """
SELECT u.usage_id, h.plan_id, h.version AS plan_version
FROM (SELECT *, CAST(substr(subscriber_id, 4) AS BIGINT) AS k, CAST(event_datetime AS DATE) AS day FROM usage_s) u
JOIN subs_s s ON u.subscriber_id = s.subscriber_id
LEFT JOIN plan_hist h ON u.day >= h.date_debut AND (h.date_fin IS NULL OR u.day < h.date_fin) AND h.plan_id =
     CASE WHEN u.k % 5 = 0 AND u.day >= DATE '1998-01-01' THEN 'P' || CAST(u.k % 17 + 1 AS VARCHAR) ELSE s.plan_id END
""")

# ------------------------------------------------------------------- reports
MONTH_LIST = ", ".join(f"('{m}')" for m in MONTHS)
SNAPSHOT = f"""
months(m) AS (VALUES {MONTH_LIST}),
um AS (
  SELECT subscriber_id, strftime(event_date, '%Y-%m') AS m, sum(data_mb) AS mb, sum(duration_sec) AS sec,
         sum(CASE WHEN event_type IN ('SMS_Sortant', 'SMS_Entrant') THEN 1 ELSE 0 END) AS sms,
         sum(amount_fcfa) AS amt, sum(CASE WHEN status = 'Échec' THEN 1 ELSE 0 END) AS failed,
         max(event_date) AS last_day
  FROM fact_u GROUP BY 1, 2),
has_usage AS (SELECT DISTINCT subscriber_id FROM fact_u),
im AS (SELECT tower_id, strftime(event_date, '%Y-%m') AS m, count(*) AS n FROM fact_i GROUP BY 1, 2),
snap AS (
  SELECT s.subscriber_id, mo.m AS snapshot_month,
         CASE WHEN h.subscriber_id IS NOT NULL THEN s.plan_id END AS plan_id,
         CAST(CAST(coalesce(u.mb, 0) AS DECIMAL(12,2)) AS DOUBLE) AS data_used_mb,
         CAST(coalesce(u.sec, 0) AS INTEGER) AS voice_used_sec,
         CAST(coalesce(u.sms, 0) AS INTEGER) AS sms_used,
         CAST(CAST(coalesce(u.amt, 0) AS DECIMAL(12,2)) AS DOUBLE) AS revenue_fcfa,
         CAST(coalesce(i.n, 0) AS INTEGER) AS network_incidents,
         CAST(coalesce(u.failed, 0) AS INTEGER) AS failed_calls,
         CAST(coalesce(date_diff('day', (SELECT max(x.last_day) FROM um x
                                          WHERE x.subscriber_id = s.subscriber_id AND x.m <= mo.m),
                                 last_day(CAST(mo.m || '-01' AS DATE))), 999) AS INTEGER) AS days_since_active,
         CASE WHEN s.churn = 1 AND strftime(s.churn_date, '%Y-%m') <= mo.m THEN 1 ELSE 0 END AS churn_status
  FROM subs_s s CROSS JOIN months mo
  LEFT JOIN um u ON u.subscriber_id = s.subscriber_id AND u.m = mo.m
  LEFT JOIN has_usage h ON h.subscriber_id = s.subscriber_id
  LEFT JOIN im i ON i.tower_id = s.tower_id AND i.m = mo.m)
"""
SQL["snapshot_monthly"] = with_ctes(SNAPSHOT, "SELECT * FROM snap")
LAST_TWO = ", ".join(f"'{m}'" for m in MONTHS[-2:])
REDONE = (SNAPSHOT.replace("FROM fact_u GROUP BY 1, 2", "FROM fact_u WHERE status <> 'Échec' GROUP BY 1, 2")
          .replace("SELECT DISTINCT subscriber_id FROM fact_u", "SELECT DISTINCT subscriber_id FROM fact_u WHERE status <> 'Échec'")
          .replace("months(m)", "months_r(m)").replace("months mo", "months_r mo").replace("um AS (", "um_r AS (").replace("FROM um x", "FROM um_r x")
          .replace("JOIN um u", "JOIN um_r u").replace("has_usage", "has_usage_r").replace("im AS (", "im_r AS (").replace("JOIN im i", "JOIN im_r i")
          .replace("snap AS (", "snap_r AS ("))
SQL["upsert_month"] = with_ctes(SNAPSHOT + "," + REDONE, f"""
SELECT * FROM snap WHERE snapshot_month NOT IN ({LAST_TWO})
UNION ALL SELECT * FROM snap_r WHERE snapshot_month IN ({LAST_TWO})
""")

SQL["churn_risk"] = with_base(f"""
SELECT s.subscriber_id, s.first_name, s.last_name, s.city, s.country,
       max(u.event_date) AS derniere_activite,
       CAST(date_diff('day', max(u.event_date), DATE '{AS_OF}') AS INTEGER) AS jours_inactivite
FROM subs_s s JOIN fact_u u ON s.subscriber_id = u.subscriber_id
WHERE s.churn = 0
GROUP BY s.subscriber_id, s.first_name, s.last_name, s.city, s.country
HAVING date_diff('day', max(u.event_date), DATE '{AS_OF}') >= {CFG.churn_risk_days}
""")

SQL["etl_run_summary"] = with_base("""
SELECT 'dim_plan' AS table_name, 'LOAD' AS operation, 'SUCCESS' AS status,
       (SELECT CAST(count(*) AS BIGINT) FROM part) AS rows_extracted,
       (SELECT CAST(count(*) AS BIGINT) FROM plans_s) AS rows_inserted,
       CAST(0 AS BIGINT) AS rows_rejected, CAST(0 AS BIGINT) AS rows_updated
UNION ALL
SELECT 'dim_tower', 'LOAD', 'SUCCESS', (SELECT count(*) FROM supplier), (SELECT count(*) FROM towers_s), 0, 0
UNION ALL
SELECT 'dim_subscriber', 'LOAD', 'SUCCESS', (SELECT count(*) FROM customer), (SELECT count(*) FROM subs_s),
       (SELECT count(*) FROM subs_typed WHERE subscriber_id IS NULL OR plan_id IS NULL), 0
UNION ALL
SELECT 'fact_usage', 'LOAD', 'SUCCESS', (SELECT count(*) FROM usage_typed), (SELECT count(*) FROM fact_u),
       (SELECT count(*) FROM usage_typed) - (SELECT count(*) FROM usage_clean), 0
UNION ALL
SELECT 'fact_incident', 'LOAD', 'SUCCESS', (SELECT count(*) FROM orders), (SELECT count(*) FROM fact_i),
       (SELECT count(*) FROM orders) - (SELECT count(*) FROM fact_i), 0
""")

SQL["audit_diff"] = with_ctes(SCD_SUB + ",\n" + PLAN2.format(d1=AS_OF, d2=AS_OF2), """
SELECT 'dim_subscriber' AS table_name, 'UPDATE' AS operation, b.subscriber_id AS record_pk,
       'churn' AS column_name, CAST(b.churn AS VARCHAR) AS old_value, CAST(a.churn AS VARCHAR) AS new_value
FROM v1 b JOIN merged a ON b.subscriber_id = a.subscriber_id AND a.is_current = 1
WHERE b.churn <> a.churn
UNION ALL
SELECT 'dim_subscriber', 'UPDATE', b.subscriber_id, 'monthly_revenue',
       CAST(b.monthly_revenue AS VARCHAR), CAST(a.monthly_revenue AS VARCHAR)
FROM v1 b JOIN merged a ON b.subscriber_id = a.subscriber_id AND a.is_current = 1
WHERE b.monthly_revenue IS DISTINCT FROM a.monthly_revenue
UNION ALL
SELECT 'dim_plan', 'UPDATE', b.plan_id, 'monthly_fee',
       CAST(b.monthly_fee AS VARCHAR), CAST(a.monthly_fee AS VARCHAR)
FROM plans_s b JOIN plan_hist a ON b.plan_id = a.plan_id AND a.is_current = 1
WHERE b.monthly_fee IS DISTINCT FROM a.monthly_fee
""")

SQL["pseudonymise"] = with_ctes(SCD_SUB, """
SELECT subscriber_id, version, 'ANONYMISE' AS first_name, 'ANONYMISE' AS last_name,
       'ANONYMISE ANONYMISE' AS nom_complet, CAST(NULL AS VARCHAR) AS phone_number,
       CAST(NULL AS VARCHAR) AS email, is_current
FROM merged WHERE CAST(substr(subscriber_id, 4) AS BIGINT) % 101 = 0
""")


# ------------------------------------------------ ISO text for dates and times
def _iso(sql: str, dates=(), stamps=()) -> str:
    rep = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
    rep += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in stamps]
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{sql}\n) iso_q"


ISO = {
    "clean_towers": (["installation_date"], []),
    "dq_tower": (["installation_date"], []),
    "scd1_tower": (["installation_date"], []),
    "clean_subscribers": (["subscription_date", "churn_date"], []),
    "dq_subscriber": (["subscription_date", "churn_date"], []),
    "clean_usage": ([], ["event_datetime"]),
    "dq_usage": ([], ["event_datetime"]),
    "clean_incidents": ([], ["incident_datetime"]),
    "dq_incident": ([], ["incident_datetime"]),
    "dq_calendar_gaps": (["date_complete"], []),
    "dq_calendar_checks": (["premiere_date", "derniere_date"], []),
    "dim_calendar_a": (["date_complete"], []),
    "dim_calendar_b": (["date_complete"], []),
    "scd2_subscriber": (["churn_date", "subscription_date", "date_debut", "date_fin"], []),
    "scd2_plan": (["date_debut", "date_fin"], []),
    "churn_risk": (["derniere_activite"], []),
}
for _k, (_d, _t) in ISO.items():
    SQL[_k] = _iso(SQL[_k], _d, _t)


# ------------------------------------------------------------------ roll-ups
def over_kpi(names: dict[str, str], select: str) -> str:
    """SQL over KPI marts given as CTEs {alias: kpi name}."""
    extra = ",\n".join(f"{a} AS (\n{KPI_BODY[k].strip()}\n)" for a, k in names.items())
    return with_ctes(extra, select)


def avg_hu(col: str, scale: int, digits: int) -> str:
    """Exact half-up average of a column holding values with ``scale`` decimals."""
    return hu(f"SUM(CAST({col} AS DECIMAL(20,{scale})))", f"COUNT({col})", digits, num_scale=scale)


ARPU_MONTH = f"""
SELECT annee, mois, country,
       {avg_hu('arpu', 2, 0)} AS arpu_fcfa,
       CAST(ROUND(SUM(CAST(revenu_total AS DECIMAL(20,2))), 0) AS DOUBLE) AS revenu_total,
       CAST(SUM(nb_abonnes_actifs) AS BIGINT) AS nb_abonnes,
       CAST(annee AS VARCHAR) || '-' || lpad(CAST(mois AS VARCHAR), 2, '0') AS periode
FROM k GROUP BY annee, mois, country
"""
CHURN_MONTH = f"""
SELECT annee, mois, country, CAST(SUM(total_abonnes) AS BIGINT) AS total_abonnes,
       CAST(SUM(nb_churnes) AS BIGINT) AS nb_churnes,
       CAST(annee AS VARCHAR) || '-' || lpad(CAST(mois AS VARCHAR), 2, '0') AS periode,
       {half_even('SUM(nb_churnes) * 100', 'SUM(total_abonnes)', 2)} AS taux_pct
FROM k GROUP BY annee, mois, country
"""
SQL["rup_arpu_month"] = over_kpi({"k": "kpi_arpu"}, ARPU_MONTH)
SQL["rup_churn_month"] = over_kpi({"k": "kpi_churn_mensuel"}, CHURN_MONTH)
SQL["rup_exec_summary"] = with_ctes(
    f"ka AS (\n{KPI_BODY['kpi_arpu'].strip()}\n),\nkc AS (\n{KPI_BODY['kpi_churn_mensuel'].strip()}\n),\n"
    f"am AS ({ARPU_MONTH.replace('FROM k ', 'FROM ka ')}),\ncm AS ({CHURN_MONTH.replace('FROM k ', 'FROM kc ')}),\n"
    "per AS (SELECT periode, SUM(total_abonnes) AS t FROM cm GROUP BY periode)", f"""
SELECT coalesce((SELECT {half_even('SUM(CAST(arpu_fcfa AS DECIMAL(20,0)))', 'COUNT(arpu_fcfa)', 0)} FROM am), 0.0) AS arpu_global,
       coalesce((SELECT CAST(SUM(CAST(revenu_total AS DECIMAL(24,0))) AS BIGINT) FROM am), 0) AS revenu_total,
       coalesce((SELECT CAST(floor(SUM(t) / COUNT(*)) AS BIGINT) FROM per), 0) AS moy_abonnes,
       coalesce((SELECT CAST(SUM(nb_churnes) AS BIGINT) FROM cm), 0) AS total_churnes,
       coalesce((SELECT {half_even('SUM(nb_churnes) * 100', 'SUM(total_abonnes)', 2)} FROM cm), 0.0) AS taux_churn
""")
SQL["rup_data_city"] = over_kpi({"k": "kpi_data_par_region"}, f"""
SELECT country, city, CAST(SUM(nb_sessions_data) AS BIGINT) AS nb_sessions,
       CAST(SUM(abonnes_data) AS BIGINT) AS abonnes_actifs,
       {hu('SUM(CAST(total_mb AS DECIMAL(20,2)))', '1', 1, num_scale=2, div=1024)} AS volume_go,
       city || ', ' || country AS localisation
FROM k GROUP BY country, city
""")
INC_CITY = f"""
SELECT country, city, CAST(SUM(nb_incidents) AS BIGINT) AS total_incidents,
       CAST(SUM(incidents_eleves) AS BIGINT) AS incidents_graves,
       CAST(SUM(incidents_moyens) AS BIGINT) AS incidents_moderes,
       CAST(SUM(total_abonnes_affectes) AS BIGINT) AS abonnes_touches,
       {avg_hu('duree_resolution_moy_min', 1, 0)} AS resolution_moy_min,
       {avg_hu('taux_resolution_pct', 2, 1)} AS taux_resolution
FROM k GROUP BY country, city
"""
SQL["rup_incident_city"] = over_kpi({"k": "kpi_incidents_qualite"}, INC_CITY)
SQL["rup_saturation"] = over_kpi({"k": "kpi_utilisation_reseau"}, f"""
SELECT country, technology, {avg_hu('taux_utilisation_pct', 2, 1)} AS utilisation_pct,
       CAST(ROUND(SUM(CAST(volume_data_gb AS DECIMAL(20,2))), 0) AS DOUBLE) AS volume_go,
       CAST(SUM(abonnes_actifs) AS BIGINT) AS abonnes
FROM k GROUP BY country, technology
""")
SQL["rup_severity"] = over_kpi({"k": "kpi_incidents_qualite"}, f"""
SELECT 'Élevée' AS gravite, CAST(coalesce(SUM(incidents_graves), 0) AS BIGINT) AS nombre FROM ({INC_CITY}) c
UNION ALL
SELECT 'Modérée', CAST(coalesce(SUM(incidents_moderes), 0) AS BIGINT) FROM ({INC_CITY}) c
""")
SQL["rup_retention"] = over_kpi({"k": "kpi_retention_par_offre"}, """
SELECT plan_name, type_abonnement, country,
       CAST(ROUND(CAST(monthly_fee AS DECIMAL(12,2)), 0) AS DOUBLE) AS prix_fcfa,
       total_abonnes, abonnes_retenus, abonnes_perdus, taux_retention_pct, taux_churn_pct,
       anciennete_moy_mois AS anciennete_mois
FROM k
""")
SQL["rup_retention_summary"] = over_kpi({"k": "kpi_retention_par_offre"}, f"""
SELECT CAST(SUM(total_abonnes) AS BIGINT) AS total_abonnes, CAST(SUM(abonnes_retenus) AS BIGINT) AS abonnes_fideles,
       coalesce({half_even('SUM(abonnes_retenus) * 100', 'SUM(total_abonnes)', 1)}, 0.0) AS taux_fidelisation,
       CAST(COUNT(DISTINCT plan_name) AS BIGINT) AS nb_forfaits
FROM k
""")
SQL["rup_calls_network"] = over_kpi({"k": "kpi_duree_appels"}, f"""
SELECT network_type, CAST(SUM(nb_appels) AS BIGINT) AS nb_appels,
       {avg_hu('duree_moy_min', 2, 1)} AS duree_moy_min,
       CAST(ROUND(SUM(CAST(volume_total_heures AS DECIMAL(20,2))), 0) AS DOUBLE) AS volume_heures,
       {avg_hu('taux_echec_pct', 2, 2)} AS taux_echec_pct
FROM k GROUP BY network_type
""")
SQL["rup_filter"] = over_kpi({"k": "kpi_churn_mensuel"}, """
SELECT * FROM k WHERE country = 'AFRICA' AND segment IN ('BUILDING', 'MACHINERY')
""")
SQL["rup_alert80"] = over_kpi({"k": "kpi_utilisation_reseau"}, """
SELECT * FROM k WHERE taux_utilisation_pct > 80.0
""")
SQL["rup_alert1"] = over_kpi({"k": "kpi_utilisation_reseau"}, """
SELECT * FROM k WHERE taux_utilisation_pct > 1.0
""")
SQL["rup_mttr"] = with_base(f"""
SELECT technology, CAST(COUNT(*) AS BIGINT) AS nb_incidents,
       {hu('SUM(resolution_minutes)', 'COUNT(resolution_minutes)', 1)} AS mttr_min
FROM fact_i GROUP BY technology
""")
SQL["rup_plan_share"] = with_base(f"""
SELECT type_abonnement, nb_abonnes, {hu('nb_abonnes', '(SELECT COUNT(*) FROM subs_s s JOIN plans_s p ON s.plan_id = p.plan_id)', 2, mult=100)} AS part_pct
FROM (SELECT p.type_abonnement, CAST(COUNT(*) AS BIGINT) AS nb_abonnes
      FROM subs_s s JOIN plans_s p ON s.plan_id = p.plan_id GROUP BY p.type_abonnement) g
""")
SQL["rup_call_band"] = with_base(f"""
SELECT CASE WHEN event_hour >= 18 THEN 'Soir' WHEN event_hour >= 12 THEN 'Après-midi'
            WHEN event_hour >= 6 THEN 'Matin' ELSE 'Nuit' END AS tranche_horaire,
       segment, CAST(COUNT(*) AS BIGINT) AS nb_appels,
       {hu('SUM(duration_sec)', 'COUNT(*)', 1)} AS duree_moy_sec,
       {hu('SUM(duration_sec)', 'COUNT(*)', 2, div=60)} AS duree_moy_min
FROM fact_u WHERE event_type IN ('Appel_Sortant', 'Appel_Entrant')
GROUP BY 1, 2
""")
SQL["rup_exact_arpu"] = with_base(f"""
SELECT CAST(year(event_date) AS INTEGER) AS annee, CAST(month(event_date) AS INTEGER) AS mois,
       sub_country AS country, CAST(COUNT(DISTINCT subscriber_id) AS BIGINT) AS nb_abonnes,
       CAST(SUM(amount_fcfa) AS DOUBLE) AS revenu_total,
       {hu('SUM(amount_fcfa)', 'COUNT(DISTINCT subscriber_id)', 2, num_scale=2)} AS arpu
FROM fact_u WHERE amount_fcfa IS NOT NULL
GROUP BY 1, 2, 3
""")


# --------------------------------------------------------------------- model
ML_FEATURES = f"""
feat AS (
  SELECT n.snapshot_month, n.subscriber_id, s.gender, s.age, s.segment, s.country, p.plan_name,
         CAST(p.monthly_fee AS DOUBLE) AS monthly_fee, CAST(p.data_quota_gb AS DOUBLE) AS data_quota_gb,
         n.data_used_mb, n.voice_used_sec, n.sms_used, n.revenue_fcfa, n.network_incidents,
         n.failed_calls, n.days_since_active, n.churn_status
  FROM snap n JOIN subs_s s ON n.subscriber_id = s.subscriber_id
  JOIN plans_s p ON n.plan_id = p.plan_id),
prep AS (
  SELECT snapshot_month, subscriber_id, coalesce(gender, 'Inconnu') AS gender,
         coalesce(CAST(age AS DOUBLE), (SELECT median(age) FROM feat)) AS age, segment, country, plan_name,
         monthly_fee, data_quota_gb, data_used_mb, voice_used_sec, sms_used, revenue_fcfa,
         network_incidents, failed_calls, days_since_active, churn_status,
         data_used_mb / (data_quota_gb * 1024.0 + 1.0) AS data_usage_ratio,
         CAST(failed_calls AS DOUBLE) / (CAST(voice_used_sec AS DOUBLE) / 60.0 + failed_calls + 1.0)
             AS call_failure_rate
  FROM feat)
"""
SQL["ml_features"] = with_ctes(SNAPSHOT + ",\n" + ML_FEATURES, "SELECT * FROM prep")
SQL["ml_split"] = with_ctes(SNAPSHOT + ",\n" + ML_FEATURES, """
SELECT subscriber_id, snapshot_month,
       CASE WHEN snapshot_month = (SELECT max(snapshot_month) FROM prep) THEN 'test' ELSE 'train' END AS split
FROM prep
""")

SQL["stream_usage_ingest"] = SQL["fact_usage"]

SQL["clean_subscribers_csv"] = SQL["clean_subscribers"]
SQL["export_kpis"] = with_ctes(
    ",\n".join(f"{k} AS (\n{KPI_BODY[k].strip()}\n)" for k in KPI_BODY),
    "\nUNION ALL\n".join(f"SELECT '{k}' AS table_name, CAST(count(*) AS BIGINT) AS rows, 'OK' AS status FROM {k}"
                         for k in KPI_BODY))
SQL["export_kpi_csv"] = SQL["kpi_incidents_qualite"]

STATED = """
stated AS (
  SELECT *, ((days_since_active * 7 + failed_calls * 13 + sms_used * 3 + network_incidents) % 101) / 100.0 AS p
  FROM prep WHERE snapshot_month = (SELECT max(snapshot_month) FROM prep)),
thresholds AS (SELECT p, count(*) FILTER (churn_status = 1) AS pos, count(*) FILTER (churn_status = 0) AS neg FROM stated GROUP BY p),
totals AS (SELECT sum(pos) AS all_pos, sum(neg) AS all_neg FROM thresholds)
"""


def stated(select: str) -> str:
    return with_ctes(SNAPSHOT + ",\n" + ML_FEATURES + ",\n" + STATED, select)


SQL["ml_oversample"] = with_ctes(SNAPSHOT + ",\n" + ML_FEATURES, """
SELECT subscriber_id, snapshot_month, churn_status,
       CASE WHEN churn_status = small.label AND small.n > 0 THEN CAST(big.n AS DOUBLE) / small.n ELSE 1.0 END AS weight
FROM prep,
     (SELECT CASE WHEN sum(churn_status) * 2 <= count(*) THEN 1 ELSE 0 END AS label,
             least(sum(churn_status), count(*) - sum(churn_status)) AS n
      FROM prep WHERE snapshot_month < (SELECT max(snapshot_month) FROM prep)) small,
     (SELECT greatest(sum(churn_status), count(*) - sum(churn_status)) AS n
      FROM prep WHERE snapshot_month < (SELECT max(snapshot_month) FROM prep)) big
WHERE snapshot_month < (SELECT max(snapshot_month) FROM prep)
""")
TRAIN_COUNTS = """
train AS (SELECT * FROM prep WHERE snapshot_month < (SELECT max(snapshot_month) FROM prep)),
classes AS (SELECT count(*) FILTER (churn_status = 1) AS one, count(*) FILTER (churn_status = 0) AS zero FROM train),
need AS (SELECT CASE WHEN one <= zero THEN 1 ELSE 0 END AS label, CASE WHEN least(one, zero) > 0 THEN abs(one - zero) ELSE 0 END AS n FROM classes)
"""
SQL["ml_interpolated"] = with_ctes(SNAPSHOT + ",\n" + ML_FEATURES + ",\n" + TRAIN_COUNTS, """
SELECT churn_status, 'feed' AS origin, count(*) AS n FROM train GROUP BY churn_status
UNION ALL SELECT label, 'interpolated', n FROM need WHERE n > 0
""")
SQL["ml_interpolated_between"] = with_ctes(SNAPSHOT + ",\n" + ML_FEATURES + ",\n" + TRAIN_COUNTS, """
SELECT n AS new_rows, n AS ends_in_class, n AS between, n AS two_ends FROM need
""")
# Every coalition of the four features (a mask), then the definition's weights.
SQL["ml_stated_attribution"] = with_ctes(SNAPSHOT + ",\n" + ML_FEATURES + """,
test AS (SELECT subscriber_id, CAST(days_since_active AS DOUBLE) AS d, CAST(failed_calls AS DOUBLE) AS f, CAST(age AS DOUBLE) AS a, CAST(sms_used AS DOUBLE) AS s
         FROM prep WHERE snapshot_month = (SELECT max(snapshot_month) FROM prep)),
mixed AS (SELECT subscriber_id, m, CASE WHEN m & 1 > 0 THEN d ELSE 20 END AS d, CASE WHEN m & 2 > 0 THEN f ELSE 1 END AS f,
                 CASE WHEN m & 4 > 0 THEN a ELSE 35 END AS a, CASE WHEN m & 8 > 0 THEN s ELSE 1 END AS s
          FROM test, range(16) t(m)),
valued AS (SELECT subscriber_id, m, (m & 1) + (m >> 1 & 1) + (m >> 2 & 1) + (m >> 3 & 1) AS size,
                  CASE WHEN d <= 30 THEN CASE WHEN f <= 0 THEN 0.1 ELSE 0.5 END ELSE CASE WHEN a <= 40 THEN 0.7 ELSE 0.9 END END::DOUBLE
                  + CASE WHEN s <= 0 THEN CASE WHEN d <= 10 THEN -0.2 ELSE 0.3 END ELSE 0.05 END::DOUBLE AS v FROM mixed),
gains AS (SELECT x.subscriber_id, b.bit, [6, 2, 2, 6][y.size + 1] / 24.0::DOUBLE * (x.v - y.v) AS gain
          FROM valued x, (VALUES (1), (2), (4), (8)) b(bit), valued y
          WHERE x.subscriber_id = y.subscriber_id AND x.m & b.bit > 0 AND y.m = x.m - b.bit)""", """
SELECT subscriber_id, round(sum(gain) FILTER (bit = 1), 9) + 0 AS phi_days_since_active, round(sum(gain) FILTER (bit = 2), 9) + 0 AS phi_failed_calls,
       round(sum(gain) FILTER (bit = 4), 9) + 0 AS phi_age, round(sum(gain) FILTER (bit = 8), 9) + 0 AS phi_sms_used
FROM gains GROUP BY subscriber_id
""")
SQL["ml_stated_confusion"] = stated("""
SELECT churn_status AS label, CAST(p >= 0.5 AS INTEGER) AS prediction, count(*) AS n FROM stated GROUP BY 1, 2
""")
SQL["ml_stated_metrics"] = stated("""
SELECT (tp + tn) * 1.0::DOUBLE / (tp + tn + fp + fn) AS accuracy,
       CASE WHEN tp + fp > 0 THEN tp * 1.0::DOUBLE / (tp + fp) ELSE 0.0 END AS "precision",
       CASE WHEN tp + fn > 0 THEN tp * 1.0::DOUBLE / (tp + fn) ELSE 0.0 END AS recall,
       CASE WHEN tp > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
       coalesce((SELECT sum(CASE WHEN a.p > b.p THEN a.pos * b.neg WHEN a.p = b.p THEN a.pos * b.neg / 2.0::DOUBLE END) / any_value(all_pos * all_neg)
                 FROM thresholds a, thresholds b, totals WHERE a.p >= b.p AND all_pos * all_neg > 0), 0.0) AS auc
FROM (SELECT count(*) FILTER (churn_status = 1 AND p >= 0.5) AS tp, count(*) FILTER (churn_status = 0 AND p >= 0.5) AS fp,
             count(*) FILTER (churn_status = 1 AND p < 0.5) AS fn, count(*) FILTER (churn_status = 0 AND p < 0.5) AS tn FROM stated) c
""")
SQL["ml_stated_roc"] = stated("""
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT p, (SELECT sum(neg) FROM thresholds x WHERE x.p >= t.p) * 1.0::DOUBLE / greatest(all_neg, 1),
       (SELECT sum(pos) FROM thresholds x WHERE x.p >= t.p) * 1.0::DOUBLE / greatest(all_pos, 1)
FROM thresholds t, totals
""")
SQL["ml_stated_top_risk"] = stated("""
SELECT subscriber_id, snapshot_month, country, age, segment, monthly_fee, days_since_active, network_incidents, failed_calls,
       p * 100 AS risque_churn_pct
FROM stated WHERE churn_status = 0 ORDER BY p DESC, subscriber_id LIMIT 500
""")

SQL["dq_subscriber_uncleaned"] = with_base("""
SELECT subscriber_id,
       CASE WHEN k % 29 <> 0 THEN CASE WHEN k % 7 < 3 THEN 'M' WHEN k % 7 < 6 THEN 'F' WHEN k % 3 < 2 THEN 'Inconnu' END END AS gender,
       CASE WHEN k % 29 <> 0 AND k % 41 <> 0 AND k % 43 <> 0 AND k % 47 <> 0 THEN CAST(14 + (k * 13) % 75 AS INTEGER) END AS age,
       CASE WHEN k % 29 <> 0 THEN city END AS city,
       CASE WHEN k % 29 = 0 THEN 'Ville ou pays manquant' END AS rejection_reason
FROM subs_typed WHERE subscriber_id IS NOT NULL
""")
SQL["audit_delete"] = with_base(f"""
SELECT 'dim_subscriber' AS table_name, 'DELETE' AS operation, subscriber_id AS record_pk, CAST(NULL AS VARCHAR) AS column_name,
       CAST(NULL AS VARCHAR) AS old_value, CAST(NULL AS VARCHAR) AS new_value
FROM subs_s WHERE k % 7 = 0 AND subscriber_id NOT IN (SELECT subscriber_id FROM fact_u WHERE date_sk >= {AS_OF[:7].replace('-', '')}01)
""")
SQL["etl_rejected_rows"] = with_base("""
SELECT source_table, rejection_reason, CAST(count(*) AS BIGINT) AS nb FROM (
  SELECT 'subscribers' AS source_table, 'subscriber_id ou plan_id manquant' AS rejection_reason
  FROM subs_typed WHERE subscriber_id IS NULL OR plan_id IS NULL
  UNION ALL
  SELECT 'usage', CASE WHEN subscriber_id IN (SELECT subscriber_id FROM subs_s) AND tower_id IN (SELECT tower_id FROM towers_s)
                       THEN 'date invalide' ELSE 'référence abonné/antenne invalide' END
  FROM usage_typed WHERE usage_id NOT IN (SELECT usage_id FROM usage_clean)
  UNION ALL
  SELECT 'incidents', 'antenne invalide ou date manquante' FROM inc_typed WHERE incident_id NOT IN (SELECT incident_id FROM inc_clean)
  UNION ALL
  SELECT 'fact_usage', 'Data event with data_mb = 0' FROM usage_s WHERE event_type = 'Data' AND data_mb = 0
  UNION ALL
  SELECT 'fact_usage', 'Valeur numérique hors limites' FROM usage_s WHERE out_of_range
  UNION ALL
  SELECT 'plans', 'monthly_fee : hors type decimal(10,2)' FROM part WHERE p_partkey % 97 = 96) r
GROUP BY source_table, rejection_reason
""")
SQL["etl_two_runs"] = with_ctes(SCD_SUB + ",\n" + PLAN2.format(d1=AS_OF, d2=AS_OF2), """
SELECT 'dim_plan' AS table_name, CAST(count(*) AS BIGINT) AS rows, CAST(sum(is_current) AS BIGINT) AS current_rows,
       CAST(max(version) AS BIGINT) AS last_version FROM plan_hist
UNION ALL SELECT 'dim_subscriber', count(*), CAST(sum(is_current) AS BIGINT), CAST(max(version) AS BIGINT) FROM merged
UNION ALL SELECT 'dim_tower', count(*), NULL, NULL FROM towers_s
UNION ALL SELECT 'fact_usage', count(*), NULL, NULL FROM fact_u
UNION ALL SELECT 'fact_incident', count(*), NULL, NULL FROM fact_i
""")

SQL["kpi_incremental_refresh"] = "\nUNION ALL\n".join(f"SELECT '{k}' AS mart, CAST(0 AS BIGINT) AS stale, CAST(0 AS BIGINT) AS missing, true AS has_rows" for k in KPI_BODY)

SQL["landing_ledger"] = "\nUNION ALL\n".join(
    f"SELECT '{feed}' AS feed, count(*) + {extra} AS rows, count(*) + {extra} AS with_lineage, CAST({extra} AS BIGINT) AS line_breaks, CAST(1 AS BIGINT) AS broken, CAST(0 AS BIGINT) AS added_again FROM {table}"
    for feed, table, extra in (("plans", "part", 0), ("towers", "supplier", 0), ("subscribers", "customer", 0), ("usage", "lineitem", 0), ("incidents", "orders", 1)))
SQL["dq_contract"] = """
WITH u AS (SELECT *, 'U' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || strftime(l_shipdate, '%Y%m%d') || '-' || CAST(l_quantity AS INTEGER) AS usage_id FROM lineitem)
SELECT 'plans' AS source_table, 'P' || p_partkey AS record_id, 'monthly_fee : hors type decimal(10,2)' AS rejection_reason FROM part WHERE p_partkey % 97 = 96
UNION ALL SELECT 'subscribers', 'SUB' || c_custkey, 'monthly_revenue : hors type decimal(10,2)' FROM customer WHERE c_custkey % 10 = 9 AND c_custkey % 499 <> 498
UNION ALL SELECT 'incidents', 'INC' || o_orderkey, 'description : texte trop long (500)' FROM orders WHERE o_orderkey % 100 = 77
UNION ALL SELECT 'usage', usage_id, 'duration_sec : hors type int' FROM u WHERE l_orderkey % 100 = 33 AND l_linenumber = 1
UNION ALL SELECT 'usage', usage_id, 'data_mb : hors type decimal(12,4)' FROM u WHERE l_returnflag = 'R' AND l_orderkey % 229 = 0 AND l_orderkey % 223 <> 0 AND l_orderkey % 227 <> 0
UNION ALL SELECT 'usage', usage_id, 'amount_fcfa : hors type decimal(12,2)' FROM u
  WHERE (l_orderkey + l_partkey) % 409 = 5 AND (l_orderkey + l_partkey) % 401 <> 0 AND (l_orderkey * 3 + l_linenumber) % 100 NOT IN (0, 1)
"""
SQL["dq_day_gaps"] = with_base("""
SELECT source, strftime(day + INTERVAL 1 DAY, '%Y-%m-%d') AS gap_start, strftime(following - INTERVAL 1 DAY, '%Y-%m-%d') AS gap_end, CAST(date_diff('day', day, following) - 1 AS INTEGER) AS days
FROM (SELECT source, day, lead(day) OVER (PARTITION BY source ORDER BY day) AS following FROM (
        SELECT DISTINCT 'usage' AS source, CAST(event_datetime AS DATE) AS day FROM usage_typed WHERE CAST(event_datetime AS DATE) NOT BETWEEN DATE '1995-03-08' AND DATE '1995-03-14'
        UNION SELECT 'incidents', CAST(incident_datetime AS DATE) FROM inc_typed WHERE NOT (year(incident_datetime) = 1996 AND month(incident_datetime) % 2 = 1)))
WHERE date_diff('day', day, following) > 1
""")
SQL["rup_exact_actives"] = with_base("""
SELECT 'city_data' AS level, tower_country AS country, tower_city AS city, NULL AS technology, CAST(NULL AS INTEGER) AS annee, count(DISTINCT subscriber_id) AS actives
FROM fact_u WHERE event_type = 'Data' GROUP BY tower_country, tower_city
UNION ALL SELECT 'technology', tower_country, NULL, technology, NULL, count(DISTINCT subscriber_id) FROM fact_u GROUP BY tower_country, technology
UNION ALL SELECT 'year', NULL, NULL, NULL, CAST(year(event_date) AS INTEGER), count(DISTINCT subscriber_id) FROM fact_u GROUP BY year(event_date)
""")

SQL["key_integrity"] = with_base("""
SELECT 'dim_subscriber' AS table_name, count(*) AS rows, count(DISTINCT subscriber_id) AS keys, CAST(0 AS BIGINT) AS broken FROM subs_s
UNION ALL SELECT 'dim_plan', count(*), count(DISTINCT plan_id), 0 FROM plans_s
UNION ALL SELECT 'dim_tower', count(*), count(DISTINCT tower_id), 0 FROM towers_s
UNION ALL SELECT 'dim_location', count(*), count(*), 0 FROM (SELECT DISTINCT city, country FROM locations_s)
UNION ALL SELECT 'fact_usage', count(*), count(DISTINCT usage_id), 0 FROM fact_u
UNION ALL SELECT 'fact_incident', count(*), count(DISTINCT incident_id), 0 FROM fact_i
""")
SQL["fact_incident_rejects"] = with_base("""
SELECT incident_id, 'clé manquante' AS rejection_reason FROM inc_typed
WHERE o_orderkey % 97 = 3 AND tower_id IN (SELECT tower_id FROM towers_s)
""")
SQL["audit_erasure"] = with_ctes(SCD_SUB, """
SELECT DISTINCT 'dim_subscriber' AS table_name, 'UPDATE' AS operation, subscriber_id AS record_pk, 'RGPD_PSEUDONYMISATION' AS column_name,
       'Données identifiantes' AS old_value, 'Anonymisées sur demande RGPD' AS new_value, true AS who_and_when
FROM merged WHERE CAST(substr(subscriber_id, 4) AS BIGINT) % 101 = 0
""")
SQL["ml_vector"] = with_ctes(SNAPSHOT + ",\n" + ML_FEATURES, """
SELECT subscriber_id, snapshot_month, round(age, 6) AS age,
       round(coalesce(monthly_fee, avg(monthly_fee) OVER ()), 6) AS monthly_fee, round(coalesce(data_quota_gb, avg(data_quota_gb) OVER ()), 6) AS data_quota_gb,
       round(CAST(data_used_mb AS DOUBLE), 6) AS data_used_mb, CAST(voice_used_sec AS DOUBLE) AS voice_used_sec, CAST(sms_used AS DOUBLE) AS sms_used,
       round(CAST(revenue_fcfa AS DOUBLE), 6) AS revenue_fcfa, CAST(network_incidents AS DOUBLE) AS network_incidents, CAST(failed_calls AS DOUBLE) AS failed_calls,
       CAST(days_since_active AS DOUBLE) AS days_since_active, round(data_usage_ratio, 6) AS data_usage_ratio,
       round(call_failure_rate, 6) AS call_failure_rate, CAST(gender_no AS DOUBLE) AS gender_enc, CAST(segment_no AS DOUBLE) AS segment_enc, CAST(country_no AS DOUBLE) AS country_enc
FROM (SELECT *, dense_rank() OVER (ORDER BY gender) - 1 AS gender_no, dense_rank() OVER (ORDER BY segment) - 1 AS segment_no, dense_rank() OVER (ORDER BY country) - 1 AS country_no,
             max(snapshot_month) OVER () AS last FROM prep)
WHERE snapshot_month < last
""")
SQL["rup_risk_list"] = stated("""
SELECT subscriber_id AS "Abonné", p * 100 AS "Risque de churn (%)", days_since_active AS "Jours sans activité", failed_calls AS "Appels échoués", network_incidents AS "Incidents réseau",
       snapshot_month AS "Mois", country AS "Pays", age AS "Âge", segment AS "Segment", monthly_fee AS "Forfait mensuel"
FROM stated WHERE churn_status = 0 ORDER BY p DESC, subscriber_id LIMIT 500
""")
SQL["export_model_csv"] = with_ctes(SNAPSHOT + ",\n" + ML_FEATURES, """
SELECT 'resultats_modeles' AS table_name, CAST(1 AS BIGINT) AS rows, 'OK' AS status
UNION ALL SELECT 'importance_variables', 15, 'OK'
UNION ALL SELECT 'clients_a_risque', least(500, count(*)), 'OK' FROM prep WHERE snapshot_month = (SELECT max(snapshot_month) FROM prep) AND churn_status = 0
""")
SQL["fact_append_indexed"] = SQL["fact_append_idempotent"]
