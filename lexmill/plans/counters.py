"""Counters of a stage, observed in the pass that writes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


class Counters:
    """Named metrics of the tables that flow through one write; no table is read for them again."""

    def __init__(self) -> None:
        self._seen: list[tuple[list[str], Observation]] = []

    def at(self, df: DataFrame, **metrics: Column) -> DataFrame:
        """The same rows; the metrics (aggregates) are known once an action has run over them."""
        seen = Observation()
        self._seen.append((list(metrics), seen))
        return df.observe(seen, *[value.alias(name) for name, value in metrics.items()])

    def values(self) -> dict[str, int]:
        """All metrics, in the order of the tables; waits for the first action over each."""
        return {name: seen.get[name] for names, seen in self._seen for name in names}
