"""Conditions with explicit null behaviour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def matching(col: str, *patterns: str) -> Column:
    """Case-insensitive regex search for any of the patterns; a null value does not match."""
    return F.coalesce(F.col(col).rlike("(?i)" + "|".join(patterns)), F.lit(False))


def not_matching(col: str, *patterns: str) -> Column:
    """Opposite of :func:`matching`, so a null value is kept."""
    return ~matching(col, *patterns)


def if_else_null(cond: Column, yes: Column | str, no: Column | str) -> Column:
    """Two-way choice whose result is null when the condition is null."""
    yes, no = (v if isinstance(v, Column) else F.lit(v) for v in (yes, no))
    return F.when(cond, yes).when(~cond, no)


def first_true(*rules: tuple[Column, str], default: str | None = None) -> Column:
    """Label of the first rule that holds; a null test counts as not holding."""
    (cond, label), *rest = rules
    out = F.when(cond, F.lit(label))
    for cond, label in rest:
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))
