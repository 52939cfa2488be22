"""Scalar parameters of a report run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class ReportParams:
    """What a run is asked for.

    ``snapshot`` is the extract date.  Left unset, the cleaning step reads it from
    the fact itself; a run that builds many reports looks it up once and sets it,
    so that the comparison reaches the scan as a literal.
    """

    eow: int
    fis_yr: int
    fis_month: int | None = None
    out_dir: str | None = None
    snapshot: date | None = None
    period: tuple[date, date] = (date(2016, 1, 31), date(2017, 1, 28))
    month_pattern: str = "DEC"
    min_units: float = 10000.0
    unit_cap: float = 10000.0
    focus_brand: str = "ATHLETA"
    focus_vendor: str | None = None
