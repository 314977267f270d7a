"""Exact aggregates, value parsing and text dates.

Rounding: the curated tables report ROUND(AVG(x), 2) and ROUND(SUM(x), 2).
Averaging doubles makes the last digit depend on summation order (and so on
partitioning).  Here the sum is taken in DECIMAL(24,8), exact and
order-independent, and the quotient is divided in decimal, then rounded
HALF_UP to 2 places.  A group with a value that this type can't hold exactly
(NaN, ±Inf, |x| >= 1e16, more than 8 decimals) is summed as DOUBLE instead, so
no value is left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUM_TYPE = "decimal(24,8)"
TOTAL_TYPE = "decimal(34,8)"        # what SUM makes of SUM_TYPE

_DIGITS = "[0-9]+(_[0-9]+)*"
# The texts Python's float() takes: decimal or exponent notation, single
# underscores between digits, NaN and infinities, surrounding blanks.
# Text that only Spark would accept ("27.5d") is refused.
NUMERIC_TEXT = (rf"^\s*[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\s*$"
                r"|^\s*[+-]?([iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_sum_decimal(c: Column | str) -> Column:
    """The value as SUM_TYPE; NULL for NULL, NaN, ±Inf or |x| >= 1e16."""
    return _col(c).try_cast(SUM_TYPE)


def misfits(c: Column | str) -> Column:
    """How many values of the group SUM_TYPE can't hold exactly."""
    same = as_sum_decimal(c).cast("double") == _col(c)
    return F.count_if(_col(c).isNotNull() & ~F.coalesce(same, F.lit(False)))


def sum_of(total: Column, double_total: Column, n_misfits: Column) -> Column:
    """ROUND(SUM, 2): of the exact total if every value fits, else of the double one."""
    return F.coalesce(F.when(n_misfits == 0, F.round(total, 2).cast("double")), F.round(double_total, 2))


def avg_of(total: Column, double_total: Column, n: Column, n_misfits: Column) -> Column:
    """ROUND(AVG, 2) in the same way; NULL if there are no values."""
    exact = F.round(F.try_divide(total, n), 2).cast("double")
    return F.coalesce(F.when(n_misfits == 0, exact), F.round(F.try_divide(double_total, n), 2))


def exact_sum(c: Column | str) -> Column:
    """ROUND(SUM(c), 2) as DOUBLE (see sum_of)."""
    return sum_of(F.try_sum(as_sum_decimal(c)), F.sum(_col(c)), misfits(c))


def exact_avg(c: Column | str) -> Column:
    """ROUND(AVG(c), 2) as DOUBLE, HALF_UP (see avg_of).

    NULL inputs are skipped (as AVG does); an all-NULL group gives NULL.
    """
    return avg_of(F.try_sum(as_sum_decimal(c)), F.sum(_col(c)), F.count(_col(c)), misfits(c))


def round2(c: Column | str) -> Column:
    return F.round(_col(c), 2)


def text_date(c: Column | str) -> Column:
    """Calendar date as written at the start of an ISO timestamp string.

    The offset is ignored on purpose: '2026-03-01T00:05:00+08:00' is
    2026-03-01 whatever the session time zone.  Malformed text gives NULL
    (also under ANSI mode) instead of failing the job.
    """
    return _col(c).try_cast("date")


def numeric_text(c: Column | str) -> Column:
    return _col(c).rlike(NUMERIC_TEXT)


def text_to_double(c: Column | str) -> Column:
    """DOUBLE of a text that passed numeric_text.  The plain cast does for most;
    underscores and the sign of a NaN are taken out where it doesn't."""
    x = _col(c)
    return F.coalesce(x.try_cast("double"),
                      F.regexp_replace(x, r"_|\s|[+-](?=[nN])", "").try_cast("double"))


def parse_value(c: Column | str) -> Column:
    """Text → DOUBLE as Python's float() reads it, else NULL."""
    x = _col(c)
    return F.when(numeric_text(x), text_to_double(x))
