"""Row counts of the stages of a job, taken while the stages run, as a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from passagemill.operators.relate import union_batches


class Audit:
    """Counts rows on their way through a job: no plan and no pass of its own per metric.

    A frame that is watched must be run exactly once, as part of an action. Spark adds up the counts of tasks that succeed; where
    an executor is lost and a stage in front of a shuffle runs again, its rows may count twice. So counts that decide something are
    taken at the end of a job or from a stored table, and ``at_least`` is for a lower bound.
    """

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}
        self._known: dict[str, int] = {}

    def watch(self, df: DataFrame, *metrics: str, **conditions: Column) -> DataFrame:
        """``df``, whose rows count for each of ``metrics``, and those that meet a condition for the metric of its name."""
        seen = Observation()
        counts = [F.count(F.lit(1)).alias(m) for m in metrics] + [F.count_if(c).alias(m) for m, c in conditions.items()]
        for metric in (*metrics, *conditions):
            if metric in self._watched or metric in self._known:
                raise ValueError(f"{metric} is counted already")
            self._watched[metric] = seen
        return df.observe(seen, *counts)

    def note(self, **values: int) -> None:
        """Counts known from elsewhere."""
        self._known.update(values)

    def count(self, metric: str) -> int:
        """Waits for the action that runs what is watched."""
        return self._known[metric] if metric in self._known else self._watched[metric].get[metric]

    def table(self, spark: SparkSession) -> DataFrame:
        """(metric, value) of all metrics."""
        rows = [(metric, self.count(metric)) for metric in (*self._known, *self._watched)]
        return spark.createDataFrame(rows, "metric string, value long")


def audit_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """(metric, value): number of rows of each of some tables, by a plan for each. Within a job, ``Audit`` counts on the way."""
    return union_batches(
        [
            df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")
            for name, df in stages.items()
        ]
    )
