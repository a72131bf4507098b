"""Null-aware numeric helpers, units and time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def to_number(c: Column | str) -> Column:
    """Text to double; anything unreadable and NaN become null."""
    return nan_to_null(_col(c).try_cast("double"))


def clip(c: Column | str, lower=None, upper=None) -> Column:
    """Bound a value; a missing value stays missing, a missing bound does not apply."""
    c = _col(c)
    out = c
    if lower is not None:
        out = F.greatest(out, lower if isinstance(lower, Column) else F.lit(lower))
    if upper is not None:
        out = F.least(out, upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(c.isNotNull(), out)


def sum0(c: Column | str) -> Column:
    """Sum in which an all-missing group gives zero."""
    return F.coalesce(F.sum(_col(c)), F.lit(0.0))


def round_half_even(c: Column | str, digits: int) -> Column:
    return F.bround(_col(c), digits)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` (either timestamp flavour)."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def floor_time(unit: str, c: Column | str) -> Column:
    """Round a wall clock down to a ``date_trunc`` unit; stays a wall clock."""
    return F.date_trunc(unit, _col(c)).cast("timestamp_ntz")


def ceil_time(unit: str, c: Column | str) -> Column:
    """Round a wall clock up to a ``date_trunc`` unit."""
    c = _col(c)
    floor = floor_time(unit, c)
    return F.when(floor == c, floor).otherwise(add_time(floor, 1, unit))


def add_time(c: Column | str, n: Column | int, unit: str = "second") -> Column:
    """Shift a timestamp by ``n`` fixed-length units."""
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    n = n if isinstance(n, Column) else F.lit(n)
    zero = F.lit(0)
    return _col(c) + F.make_dt_interval(zero, zero, zero, n * F.lit(seconds))


def bucket_start(c: Column | str, seconds: int) -> Column:
    """Start of the ``seconds`` wide bucket (counted from the epoch) holding a wall clock."""
    c = _col(c)
    offset = F.pmod(F.unix_seconds(c.cast("timestamp")), F.lit(seconds))
    return add_time(floor_time("second", c), -offset)


# Unit conversions as factor and offset (new = old * factor + offset).
UNIT_RULES = {
    "F_to_C": (5.0 / 9.0, -160.0 / 9.0),
    "C_to_F": (9.0 / 5.0, 32.0),
    "mph_to_mps": (0.44704, 0.0),
    "kmh_to_mps": (1.0 / 3.6, 0.0),
    "kW_to_MW": (0.001, 0.0),
    "MW_to_kW": (1000.0, 0.0),
    "W_to_kW": (0.001, 0.0),
    "sign_flip": (-1.0, 0.0),
}


def convert_unit(value: Column | str, rule: Column | str) -> Column:
    """Apply the named unit rule; an unknown rule leaves the value as it is."""
    rule = _col(rule)
    factor = F.create_map(*[F.lit(x) for k, (f, _) in UNIT_RULES.items() for x in (k, f)])
    offset = F.create_map(*[F.lit(x) for k, (_, o) in UNIT_RULES.items() for x in (k, o)])
    return _col(value) * F.coalesce(factor[rule], F.lit(1.0)) + F.coalesce(
        offset[rule], F.lit(0.0)
    )


def horner(x: Column, coefficients: list[float]) -> Column:
    """Polynomial with ascending ``coefficients`` evaluated at ``x``."""
    out = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(float(c))
    return out


def label_key(c: Column | str) -> Column:
    """KPI label to column key: unit dropped, separators to underscores."""
    c = F.split(F.lower(_col(c)), r" \(")[0]
    c = F.replace(c, F.lit(" - "), F.lit("_"))
    c = F.replace(c, F.lit(" "), F.lit("_"))
    return F.replace(c, F.lit("/system"), F.lit(""))


def header_key(c: Column | str) -> Column:
    """Table header to column key: lower case, blanks to underscores, no brackets."""
    return F.regexp_replace(F.replace(F.lower(_col(c)), F.lit(" "), F.lit("_")), r"[()]", "")


def letters_part(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "[^A-Za-z]", "")


def digits_part(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "").try_cast("bigint")


def short_year_date(text: Column | str, fmt: str) -> Column:
    """Date with a two-digit year: 69 to 99 are nineteen hundreds, the rest two thousands."""
    day = F.to_date(F.try_to_timestamp(_col(text), F.lit(fmt)))
    return F.when(F.year(day) > 2068, F.add_months(day, -1200)).otherwise(day)
