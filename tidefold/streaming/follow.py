"""Continuous ingest: each micro-batch is one batch of the engine, committed under its stream's id."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.order import running_total
from ..plans.config_store import ConfigWatcher
from ..plans.engine import Engine
from ..plans.ingest import UploadResult

LOG = logging.getLogger(__name__)


def sequenced(batch: DataFrame) -> DataFrame:
    """(line, seq from 1 on) of (line, file, at): by file, then place; the same again if the batch is replayed.

    A file's numbers begin after the bytes that the batch has of the files before it, so none overlap.
    """
    files = batch.groupBy("file").agg(F.min("at").alias("low"), F.max(F.col("at") + F.octet_length("line")).alias("high"))
    files = running_total(files, "file", F.col("high") - F.col("low") + 1, "before")
    rows = batch.join(files.select("file", "low", "before"), "file")
    return rows.select("line", (F.col("before") + F.col("at") - F.col("low") + 1).alias("seq"))


class Reporter:
    """Sums results; reports the sum each interval, and a summary at the end."""

    def __init__(self, interval: float = 60.0, report: Callable[[str, dict], None] | None = None) -> None:
        self.interval, self.report = interval, report or (lambda kind, stats: LOG.info("%s: %s", kind, stats))
        self.total, self.batches, self.began, self.last = UploadResult(), 0, time.monotonic(), time.monotonic()
        self.lock = threading.Lock()

    def stats(self) -> dict:
        took = max(time.monotonic() - self.began, 1e-9)
        return {**self.total.to_dict(), "batches": self.batches, "seconds": round(took, 3), "lines_per_second": round(self.total.lines / took, 1)}

    def add(self, _: int, result: UploadResult) -> None:
        with self.lock:
            self.total += result
            self.batches += 1
            if time.monotonic() - self.last >= self.interval:
                self.last = time.monotonic()
                self.report("statistics", self.stats())

    def close(self) -> None:
        with self.lock:
            self.report("summary", self.stats())


def follow(
    engine: Engine,
    stream: DataFrame,
    checkpoint: str,
    trigger: dict | None = None,
    on_result: Callable[[int, UploadResult], None] = lambda *_: None,
    wait_for_config: bool = False,
) -> StreamingQuery:
    """Start ingesting a stream of (line, file, at).

    Published rules are looked up for each batch; a set that doesn't compile leaves the last good one in
    force. With ``wait_for_config`` nothing is read before a set was applied. A batch is known in the
    store by the query's id, so a new checkpoint is a stream of its own.
    """
    watcher = ConfigWatcher(engine.fetch_config, engine.apply_published)
    while wait_for_config and not watcher.ready:
        watcher.poll()
        time.sleep(0 if watcher.ready else 0.2)
    query_id: list[str] = []

    def one(batch: DataFrame, batch_id: int) -> None:
        watcher.poll()
        if not query_id:
            query_id.append(batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint)
        on_result(batch_id, engine.run(sequenced(batch), stream=query_id[0], batch=batch_id))

    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()

