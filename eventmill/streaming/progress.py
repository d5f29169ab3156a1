"""Progress of a running stream."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Keeps the last ``keep`` progress reports: batch, pages in, pages per second."""

    def __init__(self, keep: int = 100):
        self.keep = keep
        self.reports: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.reports.append(
            {
                "batch_id": p.batchId,
                "pages": p.numInputRows,
                "pages_per_second": p.processedRowsPerSecond,
            }
        )
        del self.reports[: -self.keep]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
