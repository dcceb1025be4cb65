"""Progress and settings of a job: figures that are observed while its tables are computed anyway, without a pass of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


class Report:
    """Figures by name.  ``watch`` adds aggregates to a table; they are there once an action has run over it."""

    def __init__(self, **settings):
        self.settings = settings
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, **figures: Column) -> DataFrame:
        self._seen[name] = Observation()
        return df.observe(self._seen[name], *(c.alias(k) for k, c in figures.items()))

    def figures(self) -> dict[str, int | float]:
        """{name.figure: value}; waits for the action that computes them."""
        return {f"{name}.{k}": v for name, seen in self._seen.items() for k, v in seen.get.items()}

    def lines(self) -> list[str]:
        """``key=value`` lines of settings, then of figures."""
        return [f"{k}={v}" for k, v in {**self.settings, **self.figures()}.items()]


def watched(report: Report | None, df: DataFrame, name: str, **figures: Column) -> DataFrame:
    return report.watch(df, name, **figures) if report else df
