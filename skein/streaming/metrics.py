"""Progress facts of a finished or running query."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


def batch_progress(query: StreamingQuery) -> list[dict]:
    """Per micro-batch: id, input rows, watermark, state rows, late rows dropped."""
    out = []
    for p in query.recentProgress:
        state = p.get("stateOperators") or [{}]
        out.append(
            {
                "batch_id": p.get("batchId"),
                "input_rows": p.get("numInputRows"),
                "watermark": (p.get("eventTime") or {}).get("watermark"),
                "state_rows": sum(s.get("numRowsTotal", 0) for s in state),
                "dropped_late": sum(s.get("numRowsDroppedByWatermark", 0) for s in state),
            }
        )
    return out


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows dropped because their window had closed, in the batches whose progress Spark still keeps
    (``spark.sql.streaming.numRecentProgressUpdates``); :class:`LateRowTotals` counts all."""
    return sum(b["dropped_late"] for b in batch_progress(query))


def final_watermark(query: StreamingQuery) -> str | None:
    """The watermark that the query's last micro-batch worked with; None before the first."""
    marks = [b["watermark"] for b in batch_progress(query) if b["watermark"]]
    return marks[-1] if marks else None


class LateRowTotals(StreamingQueryListener):
    """Late rows dropped by each query, added up batch by batch for as long as the session lives.

    One number and one batch id per query, however long it runs; a batch that
    is reported again (a retry, an idle trigger) counts once.
    """

    def __init__(self) -> None:
        self._seen: dict[str, tuple[int, int, int]] = {}  # query id -> total, last batch, its rows

    @classmethod
    def attach(cls, spark: SparkSession) -> "LateRowTotals":
        totals = cls()
        spark.streams.addListener(totals)
        return totals

    def add(self, query_id: str, batch_id: int, rows: int) -> None:
        total, last, of_last = self._seen.get(query_id, (0, -1, 0))
        if batch_id > last:
            self._seen[query_id] = total + rows, batch_id, rows
        elif batch_id == last and rows > of_last:
            self._seen[query_id] = total + rows - of_last, last, rows

    def total(self, query: StreamingQuery) -> int:
        return self._seen.get(str(query.id), (0, -1, 0))[0]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.add(str(p.id), p.batchId, sum(s.numRowsDroppedByWatermark for s in p.stateOperators))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
