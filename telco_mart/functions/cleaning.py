"""Column-level cleaning expressions (all built-in, no Python UDFs).

Text is coerced with ``try_*`` functions so bad values become NULL under ANSI
mode; numbers are guarded by a regex because Spark would also accept 'nan',
'Infinity' or '1.0d', which a CSV number parser rejects.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from telco_mart import config as C

NUMBER_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    c = _c(c)
    return F.when(F.trim(c) != "", c)


def to_number(c) -> Column:
    """Text -> DOUBLE, NULL when not a plain decimal number."""
    t = F.trim(_c(c).cast("string"))
    return F.when(t.rlike(NUMBER_RE), t.try_cast("double"))


def to_int(c, fill: int | None = None) -> Column:
    """Text -> INT truncated toward zero; NULL (or ``fill``) when not a number."""
    n = to_number(c)
    if fill is not None:
        n = F.coalesce(n, F.lit(float(fill)))
    return n.try_cast("int")


def to_timestamp(c) -> Column:
    """'yyyy-MM-dd[ HH:mm:ss]' -> TIMESTAMP; invalid dates (2024-13-01) -> NULL."""
    t = F.trim(_c(c))
    return F.coalesce(F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")),
                      F.try_to_timestamp(t, F.lit("yyyy-MM-dd")))


def to_date(c) -> Column:
    return to_timestamp(c).cast("date")


def parse_flag(c) -> Column:
    """'true'/'1' (any case) -> 1, anything else (NULL included) -> 0."""
    return F.coalesce(F.lower(F.trim(_c(c))).isin("true", "1"), F.lit(False)).cast("int")


def fill_text(c, value: str, strip: bool = False) -> Column:
    c = _c(c)
    if strip:
        c = F.trim(c)
    return F.coalesce(c, F.lit(value))


def clean_gender(c) -> Column:
    """NULL -> Inconnu; upper + strip; anything but M/F -> Inconnu."""
    g = F.upper(F.trim(_c(c)))
    return F.when(g.isin("M", "F"), g).otherwise(F.lit(C.UNKNOWN))


def valid_age(c, lo: int = C.AGE_MIN, hi: int = C.AGE_MAX) -> Column:
    """Numeric age, NULL outside [lo, hi]."""
    n = to_number(c)
    return F.when(n.between(lo, hi), n).try_cast("int")


def age_band(age) -> Column:
    a = _c(age)
    out = F.when(a.isNull(), F.lit(C.UNKNOWN))
    for upper, label in C.AGE_BANDS:
        out = out.when(a < upper, F.lit(label))
    return out.otherwise(F.lit(C.AGE_OLDEST))


def price_category(fee, country, bands: dict, default: tuple) -> Column:
    """Économique below the low band of the country, Standard below the high
    band, Premium otherwise (a NULL fee falls through to Premium)."""
    fee, country = _c(fee), _c(country)
    low, high = F.lit(default[0]), F.lit(default[1])
    for name, (lo, hi) in sorted(bands.items()):
        low = F.when(country == name, F.lit(lo)).otherwise(low)
        high = F.when(country == name, F.lit(hi)).otherwise(high)
    lab = C.PRICE_LABELS
    return (F.when(fee < low, F.lit(lab[0])).when(fee < high, F.lit(lab[1]))
            .otherwise(F.lit(lab[2])))


def zone_type(city, urban: Iterable[str]) -> Column:
    return F.when(_c(city).isin(list(urban)), F.lit(C.ZONE_LABELS[0])).otherwise(F.lit(C.ZONE_LABELS[1]))


def population_zone(city, large: Iterable[str], medium: Iterable[str]) -> Column:
    city = _c(city)
    lab = C.POPULATION_LABELS
    return (F.when(city.isin(list(large)), F.lit(lab[0]))
            .when(city.isin(list(medium)), F.lit(lab[1])).otherwise(F.lit(lab[2])))


def timezone(country) -> Column:
    out = F.lit(C.DEFAULT_TIMEZONE)
    for name, tz in C.TIMEZONES.items():
        out = F.when(_c(country) == name, F.lit(tz)).otherwise(out)
    return out


def valid_email(c) -> Column:
    """E-mail kept only when it looks like x@y.zz (LIKE '%_@_%.__%')."""
    c = _c(c)
    return F.when(c.like("%_@_%.__%"), c)


def non_negative(c) -> Column:
    """Negative -> 0, NULL stays NULL."""
    c = _c(c)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def negative_to_null(c) -> Column:
    c = _c(c)
    return F.when(c >= 0, c)


def in_range_or_null(c, lo: float, hi: float) -> Column:
    c = _c(c)
    return F.when(c.between(lo, hi), c)


def truncate_text(c, n: int) -> Column:
    return F.substring(_c(c), 1, n)
