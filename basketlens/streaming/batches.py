"""How large the batches of a stream were."""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener


class BatchLog(StreamingQueryListener):
    """Name of the stream, batch, rows and milliseconds of every batch that had rows, as Spark reports them."""

    def __init__(self) -> None:
        self.batches: list[tuple[str, int, int, int]] = []
        self._running: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._change:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            self.batches.append((p.name, p.batchId, p.numInputRows, p.batchDuration))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._running.discard(str(event.runId))
            self._change.notify_all()

    def settled(self, seconds: float = 30.0) -> bool:
        """Waits until the ends of all streams that were started have been reported; False if that takes too long."""
        with self._change:
            return self._change.wait_for(lambda: not self._running, seconds)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.batches, "stream string, batch_id bigint, n_rows bigint, milliseconds bigint")


@contextlib.contextmanager
def followed(spark: SparkSession) -> Iterator[BatchLog]:
    """The log of the streams that are started and awaited inside."""
    log = BatchLog()
    spark.streams.addListener(log)
    try:
        yield log
        log.settled()
    finally:
        spark.streams.removeListener(log)
