"""Checks of a run that ride on its own passes.

A watched table carries metrics along while some job of the run reads it, so a check costs no
job of its own.  When the run has written its files, the metrics are judged; a run that fails a
check is not published.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import IMPACT_COLUMNS
from . import domains


class CheckFailed(ValueError):
    """A run whose tables break a rule."""


@dataclass
class RunChecks:
    """The checks of one run: what each watched table has to show."""

    _watched: list[tuple[str, Observation, Callable[[dict[str, Any]], bool]]] = field(default_factory=list)

    def watch(
        self, df: DataFrame, name: str, metrics: dict[str, Column], holds: Callable[[dict[str, Any]], bool]
    ) -> DataFrame:
        """The same table; the first job that reads it fills in the metrics.

        Put it above the filters of a table: metrics are of the rows that pass here, so Spark
        cannot move a filter below them.
        """
        observation = Observation(name)
        self._watched.append((name, observation, holds))
        return df.observe(observation, *(c.alias(n) for n, c in metrics.items()))

    def one_snapshot_date(self, fact: DataFrame, name: str) -> DataFrame:
        """All lines come from one extract."""
        metrics = {"first": F.min("Data_Pulled"), "last": F.max("Data_Pulled"), "lines": F.count("*")}
        return self.watch(fact, name, metrics, lambda m: m["first"] == m["last"])

    def known_markets(self, table: DataFrame, centre: str, market: str) -> DataFrame:
        """Every centre of the published market lists has its market.

        Centres that no market lists, some of the dashboard's own among them, are counted.
        """
        listed = F.col(centre).isin(*(c for centres in domains.MARKET_CENTRES.values() for c in centres))
        lost = F.col(centre).isNotNull() & F.col(market).isNull()
        metrics = {"without_market": F.count_if(lost & listed), "unlisted": F.count_if(lost & ~listed)}
        return self.watch(table, "known_markets", metrics, lambda m: m["without_market"] == 0)

    def shares_add_up(self, table: DataFrame, name: str) -> DataFrame:
        """The shares of each row make one, or are all missing."""
        total = F.col(IMPACT_COLUMNS[-1])
        off = F.max(F.when(~F.isnan(total), F.abs(total - 1)))
        holds = lambda m: m["farthest"] is None or m["farthest"] < 1e-9
        return self.watch(table, name, {"farthest": off, "rows": F.count("*")}, holds)

    def verify(self) -> dict[str, dict[str, Any]]:
        """All metrics by check; raises :class:`CheckFailed` if one does not hold.

        Call it when the jobs that read the watched tables have ended.  A table that Spark
        knew to be empty before any task ran has no metrics, and nothing to hold.
        """
        found = {name: _metrics(observation) for name, observation, _ in self._watched}
        broken = [name for name, _, holds in self._watched if found[name] and not holds(found[name])]
        if broken:
            raise CheckFailed("; ".join(f"{name}: {found[name]}" for name in broken))
        return found


def _metrics(observation: Observation) -> dict[str, Any]:
    try:
        return observation.get
    except Py4JJavaError as e:
        # What Spark raises for an observation whose part of the plan was optimised away.
        if e.java_exception.getClass().getName() == "java.lang.AssertionError":
            return {}
        raise
