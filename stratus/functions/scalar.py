"""Column-expression helpers (all JVM-side, all inside whole-stage codegen).

Rounding (T10): the source system rounds doubles as ``round(x * 10^d) / 10^d``
with ties away from zero, while Spark's ``round`` rounds the decimal text of
the double, so 0.285 -> 0.29 in Spark and 0.28 in the source. ``duck_round``
reproduces the former; ``half_even_round`` reproduces the notebook
(pandas/numpy) rounding ``rint(x * 10^d) / 10^d``.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratus.schemas import METRIC_UNITS, POLLUTANT_FALLBACK, STANDARD_WORKBOOK_NAME

# A number as the pandas parser accepts it: optional sign, digits with an
# optional fraction, optional exponent, or an infinity literal. Anything else
# (e.g. '1d', hex floats, which Java would accept) is not a number.
_NUMERIC = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def count_if(cond: Column) -> Column:
    """Number of rows for which the condition holds (a condition that is NULL does not hold)."""
    return F.count(F.when(cond, F.lit(1)))


def duck_round(col, digits: int = 2) -> Column:
    """``round(x * 10^d) / 10^d`` on doubles, ties away from zero."""
    scale = float(10**digits)
    x = _c(col).cast("double")
    return F.round(x * F.lit(scale), 0) / F.lit(scale)


def half_even_round(col, digits: int = 2) -> Column:
    """pandas ``Series.round``: ``rint(x * 10^d) / 10^d``."""
    scale = float(10**digits)
    x = _c(col).cast("double")
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def pct(numerator, denominator, digits: int | None = 2) -> Column:
    """``numerator * 100.0 / denominator`` as double, 0 when the denominator is 0."""
    num = _c(numerator).cast("double") * F.lit(100.0)
    den = _c(denominator).cast("double")
    ratio = F.try_divide(num, den)
    value = ratio if digits is None else duck_round(ratio, digits)
    return F.when(den == 0, F.lit(0.0)).otherwise(value)


def python_strip(col) -> Column:
    """``str.strip()``: remove leading/trailing whitespace of any kind.

    The pattern's ``$`` also matches before a last line end; where that is no whitespace of ``\\s`` the pattern decides,
    else trimming gives the same at a fraction of the time.
    """
    c = _c(col)
    odd_end = c.endswith("\u0085") | c.endswith("\u2028") | c.endswith("\u2029")
    return F.when(odd_end, F.regexp_replace(c, r"^\s+|\s+$", "")).otherwise(F.btrim(c, F.lit(" \t\n\x0b\f\r")))


def null_sentinels(col, tokens: Iterable[str]) -> Column:
    """Missing-value tokens -> NULL (exact cell match, as in the spreadsheets)."""
    c = _c(col)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def to_number(col) -> Column:
    """Guarded numeric coercion: non-numbers and NaN -> NULL, infinities kept."""
    c = _c(col).cast("string")
    parsed = F.when(c.rlike(_NUMERIC), python_strip(c).try_cast("double"))
    return F.nanvl(parsed, F.lit(None).cast("double"))


def to_ts(col, formats: Iterable[str]) -> Column:
    """First format that parses wins; unparseable text -> NULL (TIMESTAMP_NTZ)."""
    c = _c(col).cast("string")
    tried = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats]
    out = tried[0] if len(tried) == 1 else F.coalesce(*tried)
    return out.cast("timestamp_ntz")


def trunc_ts(col, unit: str) -> Column:
    """``DATE_TRUNC(unit, ts)`` for wall-clock timestamps, independent of the
    session time zone (Spark's ``date_trunc`` would pass through a zoned type).
    """
    c = _c(col).cast("timestamp_ntz")
    unit = unit.lower()
    if unit == "day":
        return F.to_date(c).cast("timestamp_ntz")
    if unit == "month":
        return F.trunc(F.to_date(c), "month").cast("timestamp_ntz")
    if unit == "year":
        return F.trunc(F.to_date(c), "year").cast("timestamp_ntz")
    if unit == "hour":
        return F.make_timestamp_ntz(
            F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0)
        )
    raise ValueError(f"unsupported unit {unit!r}")


#: Days in one bitmap bucket: its hours fit the 32,768 positions of a bitmap as well.
BITMAP_DAYS = 1024
BITMAP_IDS = 32768


def day_number(ts) -> Column:
    """Days since 1970-01-01 of a wall-clock timestamp."""
    return F.unix_date(F.to_date(_c(ts).cast("timestamp_ntz")))


def bitmap_of_days(ts) -> Column:
    """Aggregate: the days of one bucket (``day_number div BITMAP_DAYS``) as a bitmap."""
    return F.bitmap_construct_agg(F.pmod(day_number(ts), F.lit(BITMAP_DAYS)).cast("long"))


def bitmap_of_hours(ts) -> Column:
    """Aggregate: the hours of one bucket of days as a bitmap."""
    return F.bitmap_construct_agg((F.pmod(day_number(ts), F.lit(BITMAP_DAYS)) * 24 + F.hour(_c(ts))).cast("long"))


def bitmap_of_ids(key) -> Column:
    """Aggregate: whole numbers of one bucket (``floor(key / BITMAP_IDS)``) as a bitmap."""
    return F.bitmap_construct_agg(F.pmod(_c(key).cast("long"), F.lit(BITMAP_IDS)).cast("long"))


def bucket_of(number, size: int) -> Column:
    return F.floor(_c(number).cast("long") / F.lit(size)).cast("long")


def to_fact_value(col, scale: int = 4, precision: int = 12) -> Column:
    """NaN/infinity -> NULL, then DECIMAL(12,4).

    The warehouse narrows a double by rounding ``x * 10^scale`` to an integer
    (ties away from zero) and scaling back exactly; Spark's own double ->
    decimal cast would round the double's shortest decimal text instead,
    which differs for values such as 1709.76275. Overflow raises (ANSI).
    """
    c = _c(col).cast("double")
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    units = F.round(c * F.lit(float(10**scale)), 0).cast(f"decimal({precision + 6},0)")
    exact = units * F.lit(Decimal(1).scaleb(-scale))
    return F.when(bad, F.lit(None)).otherwise(exact).cast(f"decimal({precision},{scale})")


def normalise_station(col) -> Column:
    """Trim and unify the hyphenated Somerset West spelling."""
    return F.replace(python_strip(col), F.lit("Somerset-West"), F.lit("Somerset West"))


def metric_from_param(col) -> Column:
    """Parameter header text -> metric code ('Dir' / 'Speed' / snake case)."""
    c = _c(col)
    return (
        F.when(c.contains("Dir"), F.lit("wind_direction"))
        .when(c.contains("Speed"), F.lit("wind_speed"))
        .otherwise(F.replace(F.lower(c), F.lit(" "), F.lit("_")))
    )


def unit_of(metric_col) -> Column:
    """Unit of a metric code; NULL for metrics without a known unit."""
    pairs = []
    for k, v in METRIC_UNITS.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), _c(metric_col))


def pollutant_from_filename(col) -> Column:
    """Pollutant code from a workbook file name (None when nothing matches).

    Standard names ``YYYY_<POLLUTANT>_CCT.xls[x]`` take the middle part, with
    PM2.5/PM25, PM10 and PM1 special cases; otherwise the first pollutant of
    the fallback list contained in the name wins (NO2 is tested before NO);
    otherwise PM names are classified by the digits they contain.
    """
    up = F.upper(_c(col))
    std = F.regexp_extract(up, STANDARD_WORKBOOK_NAME, 1)
    is_std = up.rlike(STANDARD_WORKBOOK_NAME)
    std_code = (
        F.when(std.contains("PM2.5") | std.contains("PM25"), F.lit("pm25"))
        .when(std.contains("PM10"), F.lit("pm10"))
        .when(std.contains("PM1"), F.lit("pm1"))
        .otherwise(F.lower(std))
    )
    fallback = None
    for name in POLLUTANT_FALLBACK:
        cond = up.contains(name)
        fallback = F.when(cond, F.lit(name.lower())) if fallback is None else fallback.when(cond, F.lit(name.lower()))
    fallback = (
        fallback.when(up.contains("PM") & (up.contains("2.5") | up.contains("25")), F.lit("pm25"))
        .when(up.contains("PM") & up.contains("10"), F.lit("pm10"))
        .when(up.contains("PM") & up.contains("1"), F.lit("pm1"))
        .when(up.contains("PM"), F.lit("pm"))
    )
    return F.when(is_std, std_code).otherwise(fallback)
