"""Calendar dimension (``dim_date``).

Two styles are supported:

* ``"a"`` (default): Monday = 1, French names, ISO week, fixed holidays,
  wet season June-September.
* ``"b"``: Sunday = 1, English names, week numbering "mode 1" (weeks start
  on Monday, week 0 before the first Monday-started week with 4+ days),
  no holidays, wet season June-October.

The calendar is generated from ``spark.range`` over the day count of the
requested span, so its size depends only on the span (bounded: ~366 rows per
year), which is what makes it safe to broadcast into fact joins.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telco_mart import config as C
from telco_mart.functions.keys import date_key


def _names(values: list[str], idx1):
    """values[idx1 - 1] for a 1-based index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx1)


def date_spine(spark: SparkSession, start: str, end: str, partitions: int = 1) -> DataFrame:
    d0 = _dt.date.fromisoformat(start)
    n = (_dt.date.fromisoformat(end) - d0).days + 1
    return (spark.range(0, max(n, 0), 1, partitions)
            .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_complete")))


def mode1_week(d) -> F.Column:
    """Week number with weeks starting Monday, range 0-53 (MySQL WEEK mode 1)."""
    w = F.weekofyear(d)
    m = F.month(d)
    return (F.when((m == 1) & (w >= 52), F.lit(0))
            .when((m == 12) & (w == 1), F.lit(53)).otherwise(w))


def build_calendar(spark: SparkSession, start: str, end: str, style: str = "a",
                   holidays: Iterable[str] | None = None) -> DataFrame:
    """Calendar rows for every day in [start, end].

    ``holidays``: month-day strings ('MM-dd') applied to every year, or full
    ISO dates; defaults to the fixed list for style A and none for style B.
    """
    d = F.col("date_complete")
    df = date_spine(spark, start, end)
    q = F.quarter(d)
    common = [
        date_key(d).alias("date_sk"), d,
        F.dayofmonth(d).alias("jour"),
    ]
    tail = [
        F.month(d).alias("mois"),
    ]
    if style == "a":
        hol = list(C.HOLIDAYS_MM_DD if holidays is None else holidays)
        md = [h for h in hol if len(h) == 5]
        full = [h for h in hol if len(h) == 10]
        is_hol = (F.date_format(d, "MM-dd").isin(md) if md else F.lit(False))
        if full:
            is_hol = is_hol | d.isin([F.lit(x).cast("date") for x in full])
        wd = F.weekday(d)  # Monday = 0
        cols = common + [
            (wd + 1).alias("jour_semaine"),
            _names(C.DAY_NAMES_FR, wd + 1).alias("nom_jour"),
            F.weekofyear(d).alias("semaine_annee"),
            *tail,
            _names(C.MONTH_NAMES_FR, F.month(d)).alias("nom_mois"),
            q.alias("trimestre"),
            F.when(F.month(d) <= 6, 1).otherwise(2).alias("semestre"),
            F.year(d).alias("annee"),
            (wd >= 5).cast("int").alias("is_weekend"),
            (~((wd >= 5) | is_hol)).cast("int").alias("is_jour_ouvre"),
            is_hol.cast("int").alias("is_ferie"),
            F.when(F.month(d).between(6, 9), F.lit(C.WET_SEASON))
             .otherwise(F.lit(C.DRY_SEASON)).alias("saison"),
        ]
    elif style == "b":
        dow = F.dayofweek(d)  # Sunday = 1
        cols = common + [
            dow.alias("jour_semaine"),
            F.date_format(d, "EEEE").alias("nom_jour"),
            mode1_week(d).alias("semaine_annee"),
            *tail,
            F.date_format(d, "MMMM").alias("nom_mois"),
            q.alias("trimestre"),
            F.when(F.month(d) <= 6, 1).otherwise(2).alias("semestre"),
            F.year(d).alias("annee"),
            dow.isin(1, 7).cast("int").alias("is_weekend"),
            (~dow.isin(1, 7)).cast("int").alias("is_jour_ouvre"),
            F.lit(0).alias("is_ferie"),
            F.when(F.month(d).between(6, 10), F.lit(C.WET_SEASON))
             .otherwise(F.lit(C.DRY_SEASON)).alias("saison"),
        ]
    else:
        raise ValueError(f"unknown calendar style {style!r}")
    cols += [
        F.concat(F.lit("FY"), F.year(d).cast("string"), F.lit("-Q"), q.cast("string")).alias("periode_fiscale"),
        F.date_format(d, "yyyy-MM").alias("mois_annee"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), q.cast("string")).alias("annee_trimestre"),
        F.lit(None).cast("int").alias("heure"),
        F.lit(None).cast("string").alias("tranche_horaire"),
    ]
    return df.select(*cols)


def fill_calendar(existing: DataFrame, spark: SparkSession, start: str, end: str,
                  style: str = "b") -> DataFrame:
    """Rows of ``style`` for the dates of [start, end] absent from ``existing``
    (the existing rows are never rewritten); returns existing + new."""
    new = build_calendar(spark, start, end, style).join(
        existing.select("date_sk"), "date_sk", "left_anti")
    return existing.unionByName(new.select(*existing.columns))


def month_calendar(calendar: DataFrame) -> DataFrame:
    """One row per month (month key yyyymm) with the month attributes."""
    return (calendar.groupBy((F.col("annee") * 100 + F.col("mois")).alias("month_key"))
            .agg(F.first("annee").alias("annee"), F.first("mois").alias("mois"),
                 F.first("nom_mois").alias("nom_mois"),
                 F.first("annee_trimestre").alias("annee_trimestre"),
                 F.first("mois_annee").alias("mois_annee")))


def hour_band(hour) -> F.Column:
    """Time-of-day band of an hour 0-23."""
    h = F.col(hour) if isinstance(hour, str) else hour
    out = None
    for lo, label in reversed(C.HOUR_BANDS):
        out = F.when(h >= lo, F.lit(label)) if out is None else out.when(h >= lo, F.lit(label))
    return out


def calendar_checks(calendar: DataFrame) -> DataFrame:
    """Contiguity and composition summary (one row)."""
    return calendar.agg(
        F.min("date_complete").alias("premiere_date"),
        F.max("date_complete").alias("derniere_date"),
        F.count(F.lit(1)).alias("nb_jours_total"),
        (F.datediff(F.max("date_complete"), F.min("date_complete")) + 1).cast("bigint").alias("jours_attendus"),
        F.sum("is_weekend").cast("bigint").alias("nb_weekends"),
        F.sum("is_ferie").cast("bigint").alias("nb_feries"),
    )
