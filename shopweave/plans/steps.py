"""What a job saw on its way, taken in the writes that the job does anyway.

A watched frame must be written by the job: the metrics come with that write, so no table is read again
for a report. They are taken where the rows are written, after the last shuffle, so that a task that
runs again for a lost executor counts once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from ..operators.merge import literal_rows


class Steps:
    """Metrics of a job's steps, in the order in which they were asked for."""

    def __init__(self):
        self._taken: list[tuple[str, Observation | dict[str, int]]] = []

    def watch(self, step: str, frame: DataFrame, metrics: dict[str, Column]) -> DataFrame:
        """The frame, with metrics that its write will fill."""
        taken = Observation(f"{step}-{uuid.uuid4().hex}")
        self._taken.append((step, taken))
        return frame.observe(taken, *(c.alias(name) for name, c in metrics.items()))

    def add(self, step: str, **values: int) -> None:
        """Numbers that are known already."""
        self._taken.append((step, values))

    def values(self) -> dict[tuple[str, str], int]:
        """(step, metric) to its value; waits for the writes."""
        found = {}
        for step, taken in self._taken:
            metrics = taken if isinstance(taken, dict) else taken.get
            found |= {(step, name): value or 0 for name, value in metrics.items()}
        return found

    def report(self, spark: SparkSession) -> DataFrame:
        """(step, metric, value) rows; an empty report where nothing was done."""
        rows = [(step, name, value) for (step, name), value in self.values().items()]
        if not rows:
            return spark.createDataFrame([], "step string, metric string, value bigint")
        return literal_rows(spark, rows, ["step", "metric", "value"])
