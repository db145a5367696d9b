"""Running counters of a stage, reported with every micro-batch."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def count_stage(df: DataFrame, stage: str, **conditions) -> DataFrame:
    """Attach counters to a stage: ``processed`` and one per named condition."""
    return df.observe(
        stage,
        F.count(F.lit(1)).alias("processed"),
        *[F.count_if(condition).alias(name) for name, condition in conditions.items()],
    )


class StageTotals(StreamingQueryListener):
    """Adds up the counters of all stages over the batches of a query, and under ``late`` the rows
    that came after the watermark and were dropped."""

    def __init__(self) -> None:
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for stage, row in event.progress.observedMetrics.items():
            sums = self.totals.setdefault(stage, {})
            for name, value in row.asDict().items():
                sums[name] = sums.get(name, 0) + (value or 0)

        late = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        if late:
            sums = self.totals.setdefault("late", {"dropped": 0})
            sums["dropped"] += late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
