"""Scalar expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, total: Column) -> Column:
    """``part / total``, null where the total is zero (never raises under ANSI mode)."""
    return F.try_divide(part.cast("double"), total.cast("double"))


def whole(col: Column | str) -> Column:
    """Floor to a whole number, as bigint for both double and decimal input."""
    return F.floor(col).cast("bigint")


def ots_percent(on_time: Column, total: Column) -> Column:
    """Percent with one decimal, ties to even."""
    return F.bround(100 * ratio(on_time, total), 1)


def pct_text(col: Column) -> Column:
    """A fraction as display text, for example ``93.5%``."""
    return F.concat(F.format_number(100 * col, 1), F.lit("%"))


#: Most decimals that :func:`percent_digits` looks at.
MOST_DIGITS = 6


def percent_digits(share: str) -> Column:
    """The digits a column of shares is shown with, as an aggregate ``digits, shown``.

    As in the published helper, the step between two texts is the power of ten below the spread of
    the column (its largest value, if all are equal): shares from 0.85 to 0.98 are shown in
    tenths of a percent, shares from 0 to 1 in whole percent.  ``digits`` is the number of
    decimals of that step, at most six.  ``shown`` leaves out the zeros that all texts end with.
    Missing shares count for nothing; a column of zeros has whole percents.
    """
    known = f"nanvl({share}, CAST(NULL AS DOUBLE))"
    spread = f"(max({known}) - min({known}))"
    span = f"abs(CASE WHEN {spread} > 0 THEN {spread} ELSE max({known}) END)"
    digits = f"CASE WHEN {span} > 0 THEN least(CAST(-floor(log10({span})) AS INT), {MOST_DIGITS}) ELSE 0 END"

    def needed(d: int) -> str:
        """Decimals that no value needs fewer of, once the column is rounded to ``d``."""
        steps = f"abs(CAST(rint(100 * {known} * 1e{d}D) AS BIGINT))"
        zeros = f"length({steps}) - length(rtrim('0', CAST({steps} AS STRING)))"
        return f"coalesce(max(CASE WHEN {steps} = 0 THEN 0 ELSE greatest({d} - ({zeros}), 0) END), 0)"

    shown = " ".join(f"WHEN {d} THEN {needed(d)}" for d in range(MOST_DIGITS + 1))
    return F.expr(f"named_struct('digits', {digits}, 'shown', CASE {digits} {shown} ELSE 0 END)")


def pct_text_of(share: Column, digits: Column) -> Column:
    """A share as text with the digits of its column, ties to even, for example ``93.5%``."""
    step = F.pow(F.lit(10.0), digits["digits"])
    value = F.rint(100 * share * step) / step
    return F.concat(F.call_function("format_number", value, digits["shown"]), F.lit("%"))


def thousands(col: Column) -> Column:
    """A number as display text with thousands separators."""
    return F.format_number(col, 0)
