"""Column expressions shared by the loaders, KPIs and dashboard datasets.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "SLA_DAYS_BY_PRIORITY", "SIZE_TYPES", "EVENT_PRIORITIES",
    "SLA_CATEGORY_BOUNDS", "BAND_HIGH", "BAND_MEDIUM", "DEPT_NAME_PREFIX",
    "round_half_up", "round_half_up_sql", "half_point", "smart_date_key",
    "monday_week_number", "quarter_label", "weekend_flag", "sla_category",
    "satisfaction_band", "presence_flag", "breach_minutes", "strip_prefix",
    "period_label", "thousands", "minutes_between", "add_hours",
    "lower_names", "sla_hours_for_priority", "event_priority",
]

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's / the binding's for right results)
# ---------------------------------------------------------------------------
# SLA allowance, in days, per order priority (binding of SLA levels):
#   1-URGENT 90, 2-HIGH 180, 3-MEDIUM 365, 4-NOT SPECIFIED 540, 5-LOW 730
SLA_DAYS_BY_PRIORITY = {
    "1-URGENT": 90,
    "2-HIGH": 180,
    "3-MEDIUM": 365,
    "4-NOT SPECIFIED": 540,
    "5-LOW": 730,
}
# Part types that form the "Size" service category; every other type is "Line".
SIZE_TYPES = ("SMALL", "MEDIUM", "LARGE")
# Event priority by props.k mod 4: 0 NORMAL, 1 HIGH, 2 LOW, 3 URGENT.
EVENT_PRIORITIES = ("NORMAL", "HIGH", "LOW", "URGENT")
# SLA category by hours: <= 24 Same Day, <= 72 Standard, <= 168 Extended, else Long Term.
SLA_CATEGORY_BOUNDS = ((24, "Same Day"), (72, "Standard"), (168, "Extended"))
SLA_CATEGORY_ELSE = "Long Term"
# Satisfaction bands: average >= 4.0 High, >= 3.0 Medium, else Low.
BAND_HIGH = 4.0
BAND_MEDIUM = 3.0
# Department-name prefix dropped from chart labels.
DEPT_NAME_PREFIX = "Ministry of "


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Numbers
# ---------------------------------------------------------------------------
def round_half_up(c, digits: int) -> Column:
    """Half-up rounding of a double, computed as ``floor(x*10^n + 0.5) / 10^n``.

    Written this way (rather than ``F.round``) so that the same IEEE operations
    run in every engine that checks our results: ``F.round`` rounds the
    shortest decimal form of a double, other engines its binary value, and the
    two disagree on ties such as 1.005.
    """
    scale = float(10 ** digits)
    return F.floor(_c(c).cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def round_half_up_sql(expr: str, digits: int) -> str:
    """SQL text form of :func:`round_half_up` (Spark SQL and DuckDB alike)."""
    scale = 10 ** digits
    return (f"(CAST(floor(CAST({expr} AS DOUBLE) * CAST({scale} AS DOUBLE) + 0.5) AS DOUBLE)"
            f" / CAST({scale} AS DOUBLE))")


def round_half_even(c, digits: int) -> Column:
    """Rounding of a double with ties to even, ``rint(x*10^n) / 10^n``: the rule
    of the frame KPIs (3.125 gives 3.12)."""
    scale = float(10 ** digits)
    return F.rint(_c(c).cast("double") * F.lit(scale)) / F.lit(scale)


__all__.append("round_half_even")


def half_point(c) -> Column:
    """Nearest half point, ties up: ``floor(2x + 0.5) / 2``.

    (The reference draws scores with Python's ``round``, which breaks ties to
    even; see :func:`half_point_even` for that variant.)
    """
    return F.floor(_c(c) * F.lit(2.0) + F.lit(0.5)) / F.lit(2.0)


def half_point_even(c) -> Column:
    """Nearest half point with ties to even, as Python ``round(x*2)/2``."""
    return F.bround(_c(c) * F.lit(2.0), 0) / F.lit(2.0)


__all__.append("half_point_even")


def thousands(c) -> Column:
    """Integer with thousands separators: 15000 -> '15,000'."""
    return F.format_number(_c(c).cast("long"), 0)


# ---------------------------------------------------------------------------
# Dates and times
# ---------------------------------------------------------------------------
def smart_date_key(c) -> Column:
    """yyyymmdd integer key of a date or timestamp."""
    c = _c(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def monday_week_number(c) -> Column:
    """Week of year with Monday as first day; days before the first Monday are
    week 0 (C ``%W``). ISO ``weekofyear`` differs on about half of all days."""
    c = _c(c)
    return ((F.dayofyear(c) + F.lit(6) - F.weekday(c)) / F.lit(7)).cast("int")


def quarter_label(c) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_c(c)).cast("string"))


def weekend_flag(c) -> Column:
    """1 on Saturday and Sunday (``weekday`` is 0 for Monday)."""
    return (F.weekday(_c(c)) >= 5).cast("int")


def minutes_between(start, end) -> Column:
    """Elapsed minutes from ``start`` to ``end`` as decimal(10,2). The difference
    of zone-less timestamps is an interval; no session time zone takes part."""
    span = _c(end) - _c(start)
    secs = sum((F.extract(F.lit(unit), span).cast("long") * size
                for unit, size in (("HOUR", 3600), ("MINUTE", 60), ("SECOND", 1))),
               F.extract(F.lit("DAY"), span).cast("long") * 86400)
    return (secs.cast("decimal(20,2)") / F.lit(60)).cast("decimal(10,2)")


def add_hours(ts, hours) -> Column:
    """``ts + hours`` for a decimal/double number of hours (second precision)."""
    secs = (_c(hours).cast("decimal(20,2)") * F.lit(3600)).cast("long")
    return F.timestamp_add("SECOND", secs, _c(ts))


def period_label(month_name, year) -> Column:
    """'January', 2024 -> 'Jan 2024'."""
    return F.concat_ws(" ", F.substring(_c(month_name), 1, 3), _c(year).cast("string"))


# ---------------------------------------------------------------------------
# Business rules
# ---------------------------------------------------------------------------
def sla_hours_for_priority(priority) -> Column:
    """SLA hours (decimal(9,2)) for an order priority, from SLA_DAYS_BY_PRIORITY."""
    p = _c(priority)
    expr = None
    for level, days in SLA_DAYS_BY_PRIORITY.items():
        expr = (F.when(p == level, F.lit(days * 24)) if expr is None
                else expr.when(p == level, F.lit(days * 24)))
    return expr.cast("decimal(9,2)")


def sla_category(hours) -> Column:
    h = _c(hours)
    expr = None
    for bound, label in SLA_CATEGORY_BOUNDS:
        expr = F.when(h <= bound, label) if expr is None else expr.when(h <= bound, label)
    return expr.otherwise(SLA_CATEGORY_ELSE)


def satisfaction_band(avg_score, suffix: str = "") -> Column:
    """High / Medium / Low (``suffix`` = ' Satisfaction' for the SQL labels).

    A NULL average falls through to Low, as an unmatched CASE would.
    """
    a = _c(avg_score)
    return (F.when(a >= BAND_HIGH, "High" + suffix)
             .when(a >= BAND_MEDIUM, "Medium" + suffix)
             .otherwise("Low" + suffix))


def presence_flag(c) -> Column:
    """1 when the column (from the optional side of an outer join) is present."""
    return _c(c).isNotNull().cast("int")


def breach_minutes(compliant_flag, resolution_minutes, sla_hours) -> Column:
    """Minutes over the allowance for non-compliant rows, else 0.

    NULL flag -> 0; flag 0 with NULL resolution -> NULL; no clamp at zero.
    """
    over = _c(resolution_minutes) - _c(sla_hours) * F.lit(60)
    return F.when(_c(compliant_flag) == 0, over).otherwise(F.lit(0)).cast("decimal(10,2)")


def strip_prefix(c, prefix: str = DEPT_NAME_PREFIX) -> Column:
    """Remove every literal occurrence of ``prefix`` (no regex semantics)."""
    return F.replace(_c(c), F.lit(prefix), F.lit(""))


def event_priority(k) -> Column:
    """Event priority from an integer key, via EVENT_PRIORITIES[k mod 4]."""
    idx = F.pmod(_c(k).cast("long"), F.lit(len(EVENT_PRIORITIES)))
    return F.element_at(F.array(*[F.lit(p) for p in EVENT_PRIORITIES]), (idx + 1).cast("int"))


def lower_names(df):
    """Lower-case every column name of a DataFrame."""
    return df.toDF(*[c.lower() for c in df.columns])
