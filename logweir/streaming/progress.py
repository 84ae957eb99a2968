"""Progress of the running queries, for logs and dashboards. Offsets themselves are kept by the checkpoint only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql.streaming import StreamingQueryListener


@dataclass(frozen=True)
class Progress:
    query_id: str
    batch_id: int
    input_rows: int
    rows_per_second: float
    end_offsets: tuple[str, ...]


class ProgressListener(StreamingQueryListener):
    """Hands the progress of every batch to a callback; add it with ``spark.streams.addListener``."""

    def __init__(self, on_progress: Callable[[Progress], None]):
        self.on_progress = on_progress

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        offsets = tuple(source.endOffset for source in p.sources)
        self.on_progress(Progress(str(p.id), p.batchId, p.numInputRows, p.processedRowsPerSecond, offsets))

    def onQueryTerminated(self, event):
        pass
