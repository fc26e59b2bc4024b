"""Progress of a job as observed metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def run_metrics(df: DataFrame, stage: str, **extra: Column) -> tuple[DataFrame, Observation]:
    """Count rows (and more) while the data passes through, at no extra pass.

    Read ``observation.get`` after an action on the returned table.
    """
    observation = Observation(stage)
    columns = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in extra.items()]]
    return df.observe(observation, *columns), observation


def stream_metrics(df: DataFrame, stage: str, **extra: Column) -> DataFrame:
    """The same for a stream; values arrive with each progress event."""
    return df.observe(
        stage, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in extra.items()]
    )


class ProgressLog(StreamingQueryListener):
    """Keeps the observed metrics of each micro-batch, by stage, and the rows that came too late.

    ``late`` holds ``(batch, operator, rows)`` for each stateful operator that dropped rows because the
    watermark had passed them; a stream has one entry per operator and batch at most.
    """

    def __init__(self) -> None:
        self.events: list[tuple[str, int, dict]] = []
        self.late: list[tuple[int, str, int]] = []

    def late_rows(self) -> int:
        return sum(rows for _, _, rows in self.late)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for stage, row in event.progress.observedMetrics.items():
            self.events.append((stage, event.progress.batchId, row.asDict()))
        for operator in event.progress.stateOperators:
            if operator.numRowsDroppedByWatermark:
                self.late.append((event.progress.batchId, operator.operatorName, operator.numRowsDroppedByWatermark))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
