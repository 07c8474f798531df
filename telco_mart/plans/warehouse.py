"""Warehouse assembly: raw feeds -> clean -> quality -> dimensions -> facts.

A query only plans the parts it touches, and Catalyst prunes the columns it
does not read down to the parquet scans. Exact medians, the calendar span, the counts
of fact ids and the parsing of an unwritten usage feed are the only jobs that run
while a plan is built.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from telco_mart.config import WarehouseConfig
from telco_mart.operators import cleaning as CL
from telco_mart.operators import contract as K
from telco_mart.operators import dimensions as D
from telco_mart.operators import facts as FA
from telco_mart.operators import governance as G
from telco_mart.operators import quality as Q
from telco_mart.functions import cleaning as X
from telco_mart.operators.calendar import build_calendar
from telco_mart.operators.median import group_medians
from telco_mart.operators.runs import Run
from telco_mart.schemas import REJECTED_ROWS, conform
from telco_mart.session import scratch_path
from telco_mart.sources.driver_tables import DriverTables, raw_plans, raw_towers, raw_subscribers, \
    raw_usage, raw_incidents
from telco_mart.sources.raw import with_lineage

# Parameters for the driver-derived feeds: countries are region names and
# cities nation names, so price bands and city lists are given in those terms.
DRIVER_CONFIG = WarehouseConfig(
    price_bands={"AFRICA": (930.0, 970.0), "EUROPE": (920.0, 980.0)},
    default_price_band=(950.0, 990.0),
    urban_cities=("NATION_0", "NATION_5", "NATION_10"),
    large_cities=("NATION_0", "NATION_1"),
    medium_cities=("NATION_2", "NATION_3"),
)


def reject_new(run: Run, rows: DataFrame) -> DataFrame:
    """Append the quarantine rows that no committed run has stored: a row is
    known by its table, record and reason."""
    same = ["source_table", "record_id", "rejection_reason"]
    rows = conform(rows, {**REJECTED_ROWS, "record_id": "string"})
    if run.before.has("rejected_rows"):
        rows = rows.join(run.before.read("rejected_rows").select(*same).distinct(), same, "left_anti")
    return run.append("rejected_rows", rows.withColumn("run_id", F.lit(run.run_id)).select(*REJECTED_ROWS, "record_id", "run_id"))


class Warehouse:
    """Lazy star schema built from the raw feeds of a driver-table folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: WarehouseConfig = DRIVER_CONFIG,
                 feeds: dict | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg
        self.tables = DriverTables(spark, sf_dir)
        self._feeds = feeds or {}
        self._written = False  # whether the feeds are tables of a run

    # ---- raw feeds -------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        if name in self._feeds:
            return self._feeds[name]
        t = self.tables
        return {"plans": raw_plans, "towers": raw_towers, "subscribers": raw_subscribers,
                "usage": raw_usage, "incidents": raw_incidents}[name](t)

    # ---- calendar --------------------------------------------------------
    @cached_property
    def calendar_span(self) -> tuple[str, str]:
        """First and last day: as configured, or the whole years of all dates
        of the feeds (one min/max aggregate) and of ``as_of``."""
        if self.cfg.calendar_start and self.cfg.calendar_end:
            return self.cfg.calendar_start, self.cfg.calendar_end
        day = lambda feed, col: self.raw(feed).select(X.to_date(col).alias("d"))
        dates = (day("usage", "event_datetime").unionByName(day("incidents", "incident_datetime"))
                 .unionByName(day("subscribers", "subscription_date")).unionByName(day("subscribers", "churn_date")))
        first, last = self.cfg.valid_years
        low, high = dates.filter(F.year("d").between(first, last)).agg(F.year(F.min("d")), F.year(F.max("d"))).first()
        run = int(self.cfg.as_of[:4])
        return f"{min(low or run, run)}-01-01", f"{max(high or run, run)}-12-31"

    @cached_property
    def calendar(self) -> DataFrame:
        return build_calendar(self.spark, *self.calendar_span, "a")

    # ---- silver ----------------------------------------------------------
    @cached_property
    def plans(self) -> DataFrame:
        return CL.clean_plans(self.raw("plans"), self.cfg)

    @cached_property
    def _towers_dq(self) -> tuple[DataFrame, DataFrame]:
        return Q.tower_rules().apply(CL.clean_towers(self.raw("towers"), self.cfg))

    @cached_property
    def towers(self) -> DataFrame:
        return self._towers_dq[0]

    @cached_property
    def _subs(self) -> tuple[DataFrame, DataFrame]:
        return CL.clean_subscribers(self.raw("subscribers"))

    @cached_property
    def _subs_dq(self) -> tuple[DataFrame, DataFrame]:
        return Q.subscriber_rules(self.cfg.as_of).apply(self._subs[0])

    @cached_property
    def subscribers(self) -> DataFrame:
        return self._subs_dq[0]

    @property
    def subscriber_rejects(self) -> DataFrame:
        return self._subs[1]

    @cached_property
    def _usage_parsed(self) -> DataFrame:
        """Usage rows with their types. A feed that no run has written is joined and
        parsed once, into a scratch table: the medians, the counts of ids and the
        rows are all read from there."""
        typed = CL.type_usage(self.raw("usage"))
        if self._written:
            return typed
        path = scratch_path(self.spark, f"usage_{uuid.uuid4().hex[:12]}")
        typed.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(typed.schema).parquet(path)

    @cached_property
    def usage_medians(self) -> DataFrame:
        """(event_type, median) of this load's amounts; a stream that adds to
        the load fills its gaps from it."""
        return group_medians(self._usage_parsed, "amount_fcfa", "event_type")

    @cached_property
    def _usage_typed(self) -> DataFrame:
        return CL.fill_from_medians(self._usage_parsed, "amount_fcfa", "event_type", self.usage_medians)

    @cached_property
    def _usage(self) -> tuple[DataFrame, DataFrame]:
        return CL.whitelist_usage(self._usage_typed, self.subscribers, self.towers)

    @cached_property
    def _usage_dq(self) -> tuple[DataFrame, DataFrame]:
        return Q.usage_rules().apply(self._usage[0])

    @property
    def usage(self) -> DataFrame:
        return self._usage_dq[0]

    @cached_property
    def _incidents(self) -> tuple[DataFrame, DataFrame]:
        return CL.clean_incidents(self.raw("incidents"), self.towers)

    @property
    def incidents(self) -> DataFrame:
        return Q.incident_rules().apply(self._incidents[0])[0]

    @property
    def usage_quarantine(self) -> DataFrame:
        """Usage rows that a rule warns of, of those whose subscriber, tower and
        time are valid."""
        bad = F.coalesce(F.col("rejection_reason").isin(CL.BAD_REFERENCE, CL.BAD_DATE), F.lit(False))
        return Q.usage_rules().quarantined(self._usage_resolved.filter(~bad), CL.USAGE_COLUMNS)

    def quarantine(self) -> DataFrame:
        """Quarantine rows of every rule set (rejected and warned rows)."""
        return (self._subs_dq[1].unionByName(self.usage_quarantine)
                .unionByName(self._towers_dq[1]))

    # ---- dimensions ------------------------------------------------------
    @cached_property
    def dim_plan(self) -> DataFrame:
        return D.build_dim_plan(self.plans, self.cfg.as_of)

    @cached_property
    def dim_tower(self) -> DataFrame:
        return D.build_dim_tower(self.towers)

    @cached_property
    def dim_subscriber(self) -> DataFrame:
        return D.build_dim_subscriber(self.subscribers, self.cfg.as_of)

    @cached_property
    def dim_location(self) -> DataFrame:
        return D.build_dim_location(self.towers, self.cfg)

    # ---- facts -----------------------------------------------------------
    @cached_property
    def _usage_resolved(self) -> DataFrame:
        """Every usage row with its keys or the reason why it has none."""
        return FA.resolve_usage(Q.usage_rules().flagged(self._usage_typed), self.dim_subscriber, self.dim_tower, self.dim_plan,
                                self.dim_location, self.cfg, self.subscribers, self.towers, written=self._written, counted=True)

    @cached_property
    def _fact_usage(self) -> tuple[DataFrame, DataFrame]:
        return FA.split_usage(self._usage_resolved)

    @property
    def fact_usage(self) -> DataFrame:
        return self._fact_usage[0]

    @property
    def fact_usage_rejects(self) -> DataFrame:
        return self._fact_usage[1]

    @cached_property
    def _fact_incident(self) -> tuple[DataFrame, DataFrame]:
        return FA.load_fact_incident(self.incidents, self.dim_tower, self.dim_location, self.calendar, counted=True)

    @property
    def fact_incident(self) -> DataFrame:
        return self._fact_incident[0]

    @property
    def fact_incident_rejects(self) -> DataFrame:
        return self._fact_incident[1]

    def restricted(self, fact: str, months: list[int]) -> "Warehouse":
        """This warehouse with one fact cut to some months (as 199801): their
        years are partitions, so no other year is read."""
        part = Warehouse(self.spark, self.sf_dir, self.cfg, self._feeds)
        part.__dict__.update(self.__dict__)
        years = sorted({m // 100 for m in months})
        rows = getattr(self, fact).filter(F.col("annee").isin(years) & F.floor(F.col("date_sk") / 100).isin(months))
        part.__dict__[f"_{fact}"] = (rows, None)
        return part

    def rejected_rows(self) -> DataFrame:
        """Every rejected or warned row of the run, and every value of a dimension
        feed that its contract cannot hold, in the rejected-rows contract
        (source_table, raw_data, rejection_reason, rejected_at), and record_id:
        the row's key, or a digest of a row without one."""
        def shaped(source: str, key: str, df: DataFrame) -> DataFrame:
            raw = F.to_json(F.struct(*[c for c in df.columns if c != "rejection_reason"]))
            return df.select(F.lit(source).alias("source_table"), raw.alias("raw_data"), "rejection_reason",
                             F.current_timestamp().alias("rejected_at"), F.coalesce(F.col(key), F.sha2(raw.cast("binary"), 256)).alias("record_id"))
        out = shaped("subscribers", "subscriber_id", self.subscriber_rejects)
        out = out.unionByName(shaped("usage", "usage_id", self.fact_usage_rejects)).unionByName(shaped("incidents", "incident_id", self._incidents[1]))
        out = out.unionByName(shaped("fact_incident", "incident_id", self.fact_incident_rejects)).unionByName(self.quarantine())
        out = out.unionByName(K.reports([(K.FEEDS[n], self.raw(n)) for n in ("plans", "towers", "subscribers")]))
        return conform(out, {**REJECTED_ROWS, "record_id": "string"})

    # ---- materialisation ---------------------------------------------------
    def materialize(self, root: str, log=None) -> "Warehouse":
        """Load this run's feeds into the warehouse at ``root``, commit, and
        return a warehouse that reads the committed tables."""
        run = Run(self.spark, root)
        w = self.load(run, log)
        run.commit()
        return w

    def load(self, run: Run, log=None) -> "Warehouse":
        """Write this run's tables; readers see them when the caller commits.

        The first run creates the warehouse. A later run merges: dimensions take
        the new feed through their type-1 / type-2 merges; facts append the rows
        whose id they do not hold yet, rejects those that no run has stored, so
        running the same feeds again changes nothing. Each layer reads the
        *written* previous layer, and a lost executor only recomputes the layer
        being written. Keys of a fact are resolved once, written with the reason
        of every row that has none, and split from there. The root must be a
        shared folder. Facts are partitioned by year."""
        spark = self.spark
        before = run.before

        def put(name: str, df: DataFrame, write, source: str | None = None, op: str = "LOAD", **counts) -> tuple[DataFrame, dict]:
            if log is None:
                return write(df), {}
            written = []
            seen = log.write(name, op, df, lambda d: written.append(write(d)), extracted_from=source, **counts)
            return written[0], seen

        def version(name: str, df: DataFrame, source: str | None = None, op: str = "LOAD", **counts) -> DataFrame:
            return put(name, df, lambda d: run.replace(name, d), source, op, **counts)[0]

        def append(name: str, df: DataFrame, key: str, source: str, rejected: int) -> DataFrame:
            new = FA.append_new(before.read(name), df, key, years="annee") if before.has(name) else df
            return put(name, new, lambda d: run.append(name, d, ["annee"]), source, rows_rejected=rejected)[0]

        def old(name: str) -> DataFrame | None:
            return before.read(name) if before.has(name) else None

        def merged(name: str, build, audited: dict, key: str, source: str, **counts) -> DataFrame:
            """A first load as it is. A merge once, with what it changed beside
            each row; the dimension and its audit rows are both read from that."""
            if not before.has(name):
                return version(name, build(None), source, **counts)
            staged, _ = put(f"stg_{name}", build(before.read(name)), lambda d: run.replace(f"stg_{name}", d), source, op="MERGE")
            metrics = {} if log is None else {"metrics": {"rows_updated": F.count_if(F.col("_kind").isin("changed", "minor"))}}
            dim, _ = put(name, staged, lambda d: run.replace(name, d.drop("_kind", "_changes")), source, **metrics, **counts)
            run.append("audit_log", G.audit_changes(staged, name, key, audited))
            return dim

        def landed(name: str) -> DataFrame:
            """The feed with its lineage: that of its landing, or the feed's name."""
            raw = self.raw(name)
            return raw if "_source_file" in raw.columns else with_lineage(raw, name)

        feeds = {n: version(f"stg_{n}", landed(n), op="EXTRACT") for n in ("plans", "towers", "subscribers", "usage", "incidents")}
        w = Warehouse(spark, self.sf_dir, self.cfg, feeds)
        w._written = True
        dims, day = w.__dict__, self.cfg.as_of
        if log is not None:
            log.timed("medians_and_span", lambda: (w.calendar, w._usage_typed, w._subs))
        dims["calendar"] = version("dim_date", w.calendar)
        dims["dim_plan"] = merged("dim_plan", lambda was: D.build_dim_plan(w.plans, day, was, changes=was is not None), {"monthly_fee": True}, "plan_id", "stg_plans")
        feed_subscribers = w._subs
        dims["dim_tower"] = version("dim_tower", D.build_dim_tower(w.towers, old("dim_tower")), "stg_towers")
        dims["dim_location"] = version("dim_location", D.build_dim_location(w.dim_tower, self.cfg))
        dims["dim_subscriber"] = merged(
            "dim_subscriber", lambda was: D.build_dim_subscriber(w.subscribers, day, was, changes=was is not None), {"churn": False, "monthly_revenue": True},
            "subscriber_id", "stg_subscribers", rows_rejected=feed_subscribers[1].count() if log is not None else 0)
        # whitelists of the fact loads: the written dimensions (same key sets)
        dims["subscribers"], dims["towers"] = D.current(w.dim_subscriber), w.dim_tower
        dims["_usage_resolved"] = version("stg_usage_keys", w._usage_resolved, "stg_usage", op="RESOLVE")
        rejects, rejected_now = w.rejected_rows(), Observation(f"rejected_{run.run_id}")
        sources = ("usage", "incidents", "fact_incident")
        rejects = rejects.observe(rejected_now, *[F.count_if(F.col("source_table") == s).alias(s) for s in sources])
        put("rejected_rows", rejects, lambda d: reject_new(run, d), op="REJECT")
        bad = {k: int(v or 0) for k, v in rejected_now.get.items()}
        loaded, rejected = w._fact_usage
        loaded_i, rejected_i = w._fact_incident
        dims["_fact_usage"] = (append("fact_usage", loaded, "usage_id", "stg_usage", bad["usage"]), rejected)
        dims["_fact_incident"] = (append("fact_incident", loaded_i, "incident_id", "stg_incidents", bad["incidents"] + bad["fact_incident"]), rejected_i)
        return w
