"""Adapter: the driver's TPC-H-like tables -> the five raw telecom feeds.

The warehouse consumes five CSV-like feeds (all columns text, as they would
land from files): subscribers, plans, towers, usage and incidents. On the test
cluster these feeds are derived from the driver tables so that every query
scales with them:

=============  ==========================  ==================================
feed           built from                  mapping
=============  ==========================  ==================================
subscribers    customer, nation, region,   id = customer key, city = nation,
               orders (first/last order)   country = region, churn = no order
                                           since ``CHURN_CUTOFF``
plans          part, region                id = part key, fee = retail price
towers         supplier, nation, region    id = supplier key
usage          lineitem x orders           one event per line item
incidents      orders                      one incident per order
=============  ==========================  ==================================

Dirty values (bad numbers, bad dates, missing keys, out-of-range values) are
injected by fixed key rules so that cleaning and quality rules have work to
do; the same rules are written in the SQL oracle.

Only ``nation`` and ``region`` (25 and 5 rows in every TPC-H scale) and
one-row counts are broadcast explicitly; every other join is left to the
planner (AQE turns it into a broadcast only when the runtime size allows).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHURN_CUTOFF = "2000-01-01"
NO_ORDER_DATE = "1994-06-01"
TS_FMT = "yyyy-MM-dd HH:mm:ss"
DATE_FMT = "yyyy-MM-dd"
# Fixed values of the adapter (incident vocabulary of the synthetic feed).
INCIDENT_TYPES = ["Coupure réseau", "Congestion", "Panne électrique",
                  "Interférence", "Maintenance", "Vandalisme"]
TECHNOLOGIES = ["2G", "3G", "4G"]
BATTERY_STATES = ["Bon", "Moyen", "Faible"]

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


class DriverTables:
    """Lazy parquet readers for ``{sf_dir}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def geo(self) -> DataFrame:
        """nation -> (city, country)."""
        n, r = self.nation, self.region
        return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
                .select("n_nationkey", F.col("n_name").alias("city"),
                        F.col("r_name").alias("country")))


def _s(c: Column) -> Column:
    return c.cast("string")


def _pick(values: list[str], idx: Column) -> Column:
    """values[idx] for a 0-based integer column (a CASE over a short list)."""
    out = None
    for i, v in enumerate(values):
        out = (F.when(idx == i, F.lit(v)) if out is None else out.when(idx == i, F.lit(v)))
    return out


def _n_plans(t: DriverTables) -> Column:
    """Number of plans (parts), as a scalar subquery."""
    return t.part.agg(F.count(F.lit(1))).scalar()


def _n_towers(t: DriverTables) -> Column:
    """Number of towers (suppliers), as a scalar subquery."""
    return t.supplier.agg(F.count(F.lit(1))).scalar()


def raw_plans(t: DriverTables, delta: bool = False) -> DataFrame:
    """Plan feed. ``delta=True``: key % 11 == 0 raises the fee by 5 (tracked),
    key % 13 == 0 renames the plan (not tracked, ignored by the merge)."""
    p = t.part
    r = t.region
    k = F.col("p_partkey")
    fee = F.col("p_retailprice").cast("decimal(10,2)")
    name = F.col("p_name")
    if delta:
        fee = F.when(k % 11 == 0, fee + F.lit(5)).otherwise(fee).cast("decimal(10,2)")
        name = F.when(k % 13 == 0, F.concat(name, F.lit(" v2"))).otherwise(name)
    return (p.join(r, (k % 5) == r.r_regionkey, "left")
            .select(F.concat(F.lit("P"), _s(k)).alias("plan_id"),
                    name.alias("plan_name"),
                    F.col("r_name").alias("country"),
                    F.when(k % 97 == 96, F.lit("1e12")).otherwise(_s(fee)).alias("monthly_fee"),
                    _s(F.col("p_size")).alias("data_quota_gb"),
                    _s(F.col("p_size") * 60).alias("call_minutes"),
                    _s(F.col("p_size") * 20).alias("sms_quota"),
                    F.col("p_type").alias("type")))


def raw_towers(t: DriverTables, delta: bool = False) -> DataFrame:
    """Tower feed. ``delta=True``: key % 4 == 0 becomes 'Inactif' (overwritten),
    key % 5 == 0 reports another installation date (kept from the first load)."""
    s = t.supplier
    k = F.col("s_suppkey")
    status = F.when(k % 10 < 8, F.lit("Actif")).when(k % 10 == 8, F.lit(" Maintenance "))
    inst_days = (k * 17) % 3650
    if delta:
        status = F.when(k % 4 == 0, F.lit("Inactif")).otherwise(status)
        inst_days = F.when(k % 5 == 0, inst_days + 1).otherwise(inst_days)
    return (s.join(t.geo, s.s_nationkey == F.col("n_nationkey"), "left")
            .select(F.concat(F.lit("T"), _s(k)).alias("tower_id"),
                    F.col("s_name").alias("tower_name"),
                    F.col("city"),
                    F.concat(F.lit("Zone-"), _s(k % 3)).alias("region"),
                    F.col("country"),
                    _s((k * 37) % 200 - 100).alias("latitude"),
                    _s((k * 53) % 400 - 200).alias("longitude"),
                    F.when(k % 31 == 30, F.lit("-1"))
                     .otherwise(_s(500 + (k % 5) * 250)).alias("capacity_users"),
                    _pick(TECHNOLOGIES, k % 3).alias("technology"),
                    F.date_format(F.date_add(F.lit("2010-01-01").cast("date"),
                                             inst_days.cast("int")), DATE_FMT)
                     .alias("installation_date"),
                    status.alias("status"),
                    _pick(BATTERY_STATES, k % 4).alias("etat_batterie")))


def _customer_life(t: DriverTables) -> DataFrame:
    """First and last order date per customer (partial aggregation map-side)."""
    return (t.orders.groupBy("o_custkey")
            .agg(F.min("o_orderdate").alias("first_order"),
                 F.max("o_orderdate").alias("last_order")))


def raw_subscribers(t: DriverTables, delta: bool = False) -> DataFrame:
    """Subscriber feed. ``delta=True`` gives the second-day feed used by the
    SCD examples: key % 7 == 0 changes segment (tracked), key % 7 == 1 changes
    revenue (Type 1), key % 7 == 2 changes e-mail (Type 1)."""
    c = t.customer
    k = F.col("c_custkey")
    last = F.coalesce(F.col("last_order"), F.lit(NO_ORDER_DATE).cast("timestamp"))
    churned = last < F.lit(CHURN_CUTOFF).cast("timestamp")
    revenue = F.col("c_acctbal").cast("decimal(12,2)")
    segment = F.col("c_mktsegment")
    email = (F.when(k % 4 == 0, F.lit(None).cast("string"))
             .when(k % 4 == 1, F.concat(F.lit("user"), _s(k), F.lit("@mail.c")))
             .otherwise(F.concat(F.lit("user"), _s(k), F.lit("@mail.com"))))
    if delta:
        segment = (F.when((k % 7 == 0) & (segment == "BUILDING"), F.lit("MACHINERY"))
                   .when(k % 7 == 0, F.lit("BUILDING")).otherwise(segment))
        revenue = F.when(k % 7 == 1, revenue + F.lit(100)).otherwise(revenue)
        email = F.when(k % 7 == 2, F.concat(F.lit("new"), _s(k), F.lit("@mail.com"))).otherwise(email)
    df = (c.join(t.geo, c.c_nationkey == F.col("n_nationkey"), "left")
          .join(_customer_life(t), k == F.col("o_custkey"), "left"))
    return df.select(
        F.when(k % 499 == 498, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("SUB"), _s(k))).alias("subscriber_id"),
        F.col("c_name").alias("first_name"),
        F.concat(F.lit("Famille"), _s(F.col("c_nationkey"))).alias("last_name"),
        F.when(k % 7 < 3, F.lit("M")).when(k % 7 < 6, F.lit("F"))
         .when(k % 3 == 0, F.lit(" m")).when(k % 3 == 1, F.lit("x")).alias("gender"),
        F.when(k % 41 == 0, F.lit("abc")).when(k % 43 == 0, F.lit("120"))
         .when(k % 47 == 0, F.lit(None).cast("string"))
         .otherwise(_s(14 + (k * 13) % 75)).alias("age"),
        F.col("city"),
        F.col("country"),
        F.when(k % 503 == 502, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("P"), _s(k % _n_plans(t)))).alias("plan_id"),
        F.concat(F.lit("T"), _s(k % _n_towers(t))).alias("tower_id"),
        F.date_format(F.coalesce(F.col("first_order"), F.lit(NO_ORDER_DATE).cast("timestamp")),
                      DATE_FMT).alias("subscription_date"),
        F.concat(F.lit("+226"), F.lpad(_s(k), 8, "0")).alias("phone_number"),
        email.alias("email"),
        F.when(k % 53 == 0, F.lit("oui")).when(churned, F.lit("1"))
         .otherwise(F.lit("0")).alias("churn"),
        F.when(churned & (k % 5 != 0), F.date_format(F.date_add(last.cast("date"), 30), DATE_FMT))
         .when(~churned & (k % 11 == 0), F.date_format(last, DATE_FMT)).alias("churn_date"),
        F.when(k % 37 == 0, F.lit("n/a")).otherwise(_s(revenue)).alias("monthly_revenue"),
        segment.alias("segment"),
    )


def raw_usage(t: DriverTables) -> DataFrame:
    """One usage event per line item; the order gives the subscriber. The
    usage id carries order, line, part, supplier, ship day and quantity:
    (order, line) alone repeats in the driver tables."""
    li = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey")
    ok, ln, rf = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag")
    is_call = rf == "A"
    is_data = rf == "R"
    ts = F.col("l_shipdate") + F.make_dt_interval(hours=((ok + ln) % 24).cast("int"))
    amount = (F.col("l_extendedprice").cast("decimal(12,2)")
              * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(12,2)")
    am_key = ok * 3 + ln
    return (li.join(o, ok == F.col("o_orderkey"))
            .select(
                F.concat(F.lit("U"), _s(ok), F.lit("-"), _s(ln), F.lit("-"),
                         _s(F.col("l_partkey")), F.lit("-"), _s(F.col("l_suppkey")), F.lit("-"),
                         F.date_format("l_shipdate", "yyyyMMdd"), F.lit("-"),
                         _s(F.col("l_quantity").cast("int"))).alias("usage_id"),
                F.concat(F.lit("SUB"), _s(F.col("o_custkey"))).alias("subscriber_id"),
                F.concat(F.lit("T"), _s(F.col("l_suppkey"))).alias("tower_id"),
                F.when(is_call & (ln % 2 == 1), F.lit("Appel_Sortant"))
                 .when(is_call, F.lit("Appel_Entrant"))
                 .when((rf == "N") & (ln % 2 == 1), F.lit("SMS_Sortant"))
                 .when(rf == "N", F.lit("SMS_Entrant"))
                 .otherwise(F.lit("Data")).alias("event_type"),
                F.when((ok + ln) % 1009 == 0, F.lit("2024-13-01 00:00:00"))
                 .otherwise(F.date_format(ts, TS_FMT)).alias("event_datetime"),
                F.when(is_call & (ok % 211 == 0), F.lit("-5"))
                 .when(is_call, _s((F.col("l_quantity") * 60).cast("int"))).alias("duration_sec"),
                F.when(is_data & (ok % 223 == 0), F.lit("0"))
                 .when(is_data & (ok % 227 == 0), F.lit("-1"))
                 .when(is_data & (ok % 229 == 0), F.lit("1e12"))
                 .when(is_data, _s((F.col("l_extendedprice") / 100).cast("decimal(12,4)")))
                 .alias("data_mb"),
                F.when(am_key % 100 == 0, F.lit(None).cast("string"))
                 .when(am_key % 100 == 1, F.lit("abc"))
                 .when((ok + F.col("l_partkey")) % 401 == 0, F.lit("-3.00"))
                 .when((ok + F.col("l_partkey")) % 409 == 5, F.lit("1e12"))
                 .otherwise(_s(amount)).alias("amount_fcfa"),
                F.when(F.col("l_linestatus") == "F", F.lit("Succès"))
                 .when(ln % 3 == 0, F.lit("Interrompu"))
                 .otherwise(F.lit("Échec")).alias("status"),
                _pick(TECHNOLOGIES, ln % 3).alias("network_type"),
                F.when(F.col("l_tax") > 0.06, F.lit("1")).otherwise(F.lit("0")).alias("roaming"),
            ))


def raw_incidents(t: DriverTables) -> DataFrame:
    """One network incident per order, on tower ``orderkey % #towers``."""
    o = t.orders
    ok = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    ts = F.col("o_orderdate") + F.make_dt_interval(hours=(ok % 24).cast("int"))
    return o.select(
        F.concat(F.lit("INC"), _s(ok)).alias("incident_id"),
        F.when(ok % 307 == 0, F.lit("T999999999"))
         .otherwise(F.concat(F.lit("T"), _s(ok % _n_towers(t)))).alias("tower_id"),
        _pick(INCIDENT_TYPES, ok % 6).alias("incident_type"),
        F.when(prio.startswith("1"), F.lit("Élevé"))
         .when(prio.startswith("2") | prio.startswith("3"), F.lit("Moyen"))
         .otherwise(F.lit("Faible")).alias("severity"),
        F.when(ok % 401 == 7, F.lit("")).otherwise(F.date_format(ts, TS_FMT)).alias("incident_datetime"),
        F.when(ok % 53 == 0, F.lit("12.7")).otherwise(_s(5 + ok % 240)).alias("resolution_minutes"),
        F.when(ok % 19 == 0, F.lit("1")).when(F.col("o_orderstatus") != "P", F.lit("True"))
         .otherwise(F.lit("False")).alias("resolved"),
        F.when(ok % 20 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Incident "), _s(ok))).alias("description"),
        F.when(ok % 61 == 0, F.lit("-2")).otherwise(_s(F.col("o_custkey") % 500)).alias("nb_abonnes_affectes"),
    )


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = DriverTables(spark, sf_dir)
    return {
        "plans": raw_plans(t),
        "towers": raw_towers(t),
        "subscribers": raw_subscribers(t),
        "usage": raw_usage(t),
        "incidents": raw_incidents(t),
    }
