"""Counts that are taken while a job runs, without a pass of their own."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: What is left after each step from archives to unique positions.
STAGES = ("games", "rated", "decided", "commented", "annotated", "positions", "unique_positions")


class StageCounts:
    """Observed row counts of the steps of one job.

    Spark adds up what tasks report; if executors are lost and a stage runs again, its rows may count twice, so these are figures of progress.
    """

    def __init__(self) -> None:
        self._observed: dict[str, Observation] = {}

    def at(self, stage: str, df: DataFrame, rows=None) -> DataFrame:
        """The rows unchanged; those for which the condition `rows` holds, or all, are counted as the stage."""
        self._observed[stage] = Observation(f"{stage}_{id(self)}")
        return df.observe(self._observed[stage], (F.count("*") if rows is None else F.count_if(rows)).alias("rows"))

    def counts(self) -> dict[str, int]:
        """The counts, once an action has run over the rows; waits for it."""
        return {stage: observed.get["rows"] for stage, observed in self._observed.items()}


def counted(counts: StageCounts | None, stage: str, df: DataFrame, rows=None) -> DataFrame:
    return df if counts is None else counts.at(stage, df, rows)
