"""General column expressions (inventory X1-X18).

Everything here is a built-in Catalyst expression, so it stays inside
whole-stage codegen.  Divisions whose divisor comes from data use
``try_divide``: under ANSI mode (Spark's default) a plain ``/`` by zero
fails the job, while the original jobs expect NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` that is NULL when ``den`` is 0 or NULL (Q11)."""
    return F.try_divide(c(num), c(den))


EXACT = "decimal(38,15)"
_FINE, _COARSE = "decimal(38,32)", "decimal(38,2)"


def exact_lanes(x: Column) -> list[Column]:
    """A double as parts that can be summed in any order, each without rounding.

    Doubles count as the decimals that they print as (0.1 is a tenth).  Whole hundredths below 1e7, the usual case, go
    to a lane of longs: decimals cost many times as much.  Others from 1e-9 up to 1e14 count to 15
    decimals: what 7.0 - 4.9 leaves beyond is noise.  Smaller ones go to a lane of 32 decimals, larger ones to one of
    two (no such double has more), and those from 1e27 on, with NaN and the infinities, to a lane of doubles.
    A lane of longs or decimals holds the sum of 10 ** 9 values at least; only sums of the last lane depend on the order of rows.
    """
    size = F.abs(x)
    hundredths = F.rint(x * 100)
    short = (size < 1e7) & (hundredths / 100 == x)  # at most 9 digits: it prints as that many hundredths
    return [F.when(short, hundredths.cast("long")),
            F.when(~short & (size >= 1e-9) & (size < 1e14), x.try_cast(EXACT)), F.when(~short & (size < 1e-9), x.try_cast(_FINE)),
            F.when((size >= 1e14) & (size < 1e27), x.try_cast(_COARSE)), F.when(size >= 1e27, x)]


def exact_total(sums: Sequence[Column]) -> Column:
    """One double from the sums of ``exact_lanes``; NULL if no lane has a value.

    Hundredths and decimals are added as decimals, unless the latter make 1e20 or more.
    """
    hundredths, exact, *other = sums
    short = hundredths.cast("double") / 100
    both = (exact.try_cast("decimal(36,15)") + (hundredths.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast("decimal(21,2)"))
    usual = (F.when(exact.isNull(), short).when(hundredths.isNull(), exact.cast("double"))
             .when(F.abs(exact) < Decimal(10) ** 20, both.cast("double")).otherwise(exact.cast("double") + short))
    lanes = [usual, *[c.cast("double") for c in other]]
    whole = sum((F.coalesce(c, F.lit(0.0)) for c in reversed(lanes)), F.lit(0.0))
    return F.when(F.coalesce(*lanes).isNotNull(), whole)


def exact_sum(x: Column, over=None) -> Column:
    """The sum of doubles by ``exact_lanes``: the same whatever order rows arrive in.

    Used where a threshold or a text depends on a sum.  ``over``: a window.
    """
    return exact_total([F.sum(c) if over is None else F.sum(c).over(over) for c in exact_lanes(x)])


def strip_leading_zeros(x: ColumnOrName) -> Column:
    """``'000123' -> '123'``; an all-zero code becomes ``''``."""
    return F.regexp_replace(c(x), r"^0*", "")


def as_of_date(as_of) -> Column:
    """The run date as a DATE literal (replaces ``current_date()``, Q10)."""
    return F.lit(str(as_of)).cast("date")


def empty_if_null(x: ColumnOrName) -> Column:
    return F.coalesce(c(x), F.lit(""))


def not_in_or_null(x: ColumnOrName, values: Sequence) -> Column:
    """keep rows whose value is outside ``values`` *or* NULL."""
    return ~c(x).isin(*values) | c(x).isNull()


def is_true(x: ColumnOrName) -> Column:
    """``flag == True`` as a predicate; a NULL flag does not pass."""
    return c(x) == F.lit(True)
