"""Period arithmetic as Spark column expressions (all JVM-side, codegen'd).

A *period* is a calendar bucket of one unit (day, week, month, quarter, year).
Three encodings are used:

* ``period_start`` – the first day of the bucket (``DateType``);
* ``period_label`` – text, the partition value on disk: ``yyyy-MM-dd`` (day and
  week, Monday start), ``yyyy-MM`` (month), ``yyyyQn`` (quarter), ``yyyy`` (year);
* ``period_index`` – an integer ordinal, so "calendar-adjacent" and "L periods
  back" are integer arithmetic (month: ``year*12 + month - 1``).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..config import PERIOD_UNITS


def _check(unit: str) -> str:
    if unit not in PERIOD_UNITS:
        raise ValueError(f"unknown period unit {unit!r}; expected one of {PERIOD_UNITS}")
    return unit


def _trunc(d: Column, unit: str) -> Column:
    """First day of the period of a date, by date arithmetic alone (no time zone)."""
    return d if unit == "day" else F.trunc(d, unit)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def period_start(ts, unit: str = "month") -> Column:
    """First day of the period holding ``ts`` (a timestamp or date)."""
    return _trunc(_c(ts).cast("date"), _check(unit))


def period_index(ts, unit: str = "month") -> Column:
    """Integer ordinal of the period holding ``ts``; consecutive periods differ by 1."""
    _check(unit)
    d = _c(ts).cast("date")
    if unit == "day":
        return F.unix_date(d)
    if unit == "week":
        # 1970-01-01 is a Thursday: Monday-start week n begins on day 7n - 3.
        return F.floor((F.unix_date(F.date_trunc("week", d).cast("date")) + 3) / 7).cast("int")
    if unit == "month":
        return F.year(d) * 12 + F.month(d) - 1
    if unit == "quarter":
        return F.year(d) * 4 + F.quarter(d) - 1
    return F.year(d)


def index_start(idx, unit: str = "month") -> Column:
    """Inverse of :func:`period_index`: first day of period number ``idx``."""
    _check(unit)
    i = _c(idx).cast("int")
    if unit == "day":
        return F.date_from_unix_date(i)
    if unit == "week":
        return F.date_from_unix_date(i * 7 - 3)
    if unit == "month":
        return F.make_date(F.floor(i / 12).cast("int"), F.pmod(i, F.lit(12)) + 1, F.lit(1))
    if unit == "quarter":
        return F.make_date(F.floor(i / 4).cast("int"), F.pmod(i, F.lit(4)) * 3 + 1, F.lit(1))
    return F.make_date(i, F.lit(1), F.lit(1))


def period_label(ts, unit: str = "month") -> Column:
    """Text form of the period holding ``ts`` (the on-disk partition value)."""
    _check(unit)
    d = period_start(ts, unit)
    if unit in ("day", "week"):
        return F.date_format(d, "yyyy-MM-dd")
    if unit == "month":
        return F.date_format(d, "yyyy-MM")
    if unit == "quarter":
        return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))
    return F.year(d).cast("string")


def parse_period(text, unit: str = "month") -> Column:
    """Period text → period start date, NULL when unparseable.

    Accepts whatever ``CAST(x AS DATE)`` accepts (``yyyy``, ``yyyy-MM``,
    ``yyyy-MM-dd``, with or without a time part) plus ``yyyyQn`` quarters, then
    truncates to ``unit``.  Dates and timestamps pass straight through."""
    _check(unit)
    t = _c(text)
    s = F.trim(t.cast("string"))
    quarter = F.regexp_extract(s, r"^(\d{4})Q([1-4])$", 0) != ""
    q_date = F.make_date(
        F.regexp_extract(s, r"^(\d{4})Q([1-4])$", 1).cast("int"),
        (F.regexp_extract(s, r"^(\d{4})Q([1-4])$", 2).cast("int") - 1) * 3 + 1,
        F.lit(1),
    )
    d = F.when(quarter, q_date).otherwise(s.try_cast("date"))
    return _trunc(d, unit)


def checked_period(period: str = "period", unit: str = "month") -> Column:
    """E2 guard inside the plan: the parsed period; a text that is no period
    fails the job when its row is read, without a pass of its own."""
    start = parse_period(period, unit)
    bad = F.raise_error(F.concat(F.lit("not a period: "), _c(period).cast("string"))).cast("date")
    return F.coalesce(start, F.when(_c(period).isNotNull(), bad))


def canonical_period(spark: SparkSession, text: str, unit: str = "month") -> tuple[str, int]:
    """Label and index of the period that a text names (any form that
    :func:`parse_period` takes); an error if it names none."""
    start = parse_period(F.lit(text), unit)
    label, index = spark.range(1).select(period_label(start, unit), period_index(start, unit)).first()
    if label is None:
        raise ValueError(f"not a period of unit {unit}: {text!r}")
    return label, index


def add_periods(start, n: int, unit: str = "month") -> Column:
    """Start of the period ``n`` units after the one starting at ``start``."""
    _check(unit)
    d = _c(start).cast("date")
    if unit == "day":
        return F.date_add(d, n)
    if unit == "week":
        return F.date_add(d, 7 * n)
    if unit == "month":
        return F.add_months(d, n)
    if unit == "quarter":
        return F.add_months(d, 3 * n)
    return F.add_months(d, 12 * n)


def period_range(lo, hi, unit: str = "month") -> Column:
    """Array of period starts from ``lo`` to ``hi`` inclusive."""
    _check(unit)
    step = {"day": "1 day", "week": "7 days", "month": "1 month",
            "quarter": "3 months", "year": "1 year"}[unit]
    return F.sequence(period_start(lo, unit), period_start(hi, unit), F.expr(f"interval {step}"))
