"""Payloads that arrive: parse, build, normalise and append each micro-batch, and counts of arrivals by window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexmill.operators.dedup import write_cases


def ingest(stream: DataFrame, build: Callable[[DataFrame], DataFrame], store: str, checkpoint: str, order: list[str], every: str | None = None) -> StreamingQuery:
    """Appends the new cases of each micro-batch to the store. A batch that is run again replaces its own rows, so every key is stored once.

    ``every``: a processing-time interval for a stream that goes on; without it, what is there is taken in and the query ends. The size of a batch is bounded
    by the source's own options (maxFilesPerTrigger), which is the back pressure.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        write_cases(build(batch), store, order, batch_id)

    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def dedup_in_flight(stream: DataFrame, key: str, time: str, within: str = "1 hour") -> DataFrame:
    """Drops repeats of a key that arrive within a time of one another; the store's own keys are the lasting guarantee."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, within)
    return timed.dropDuplicatesWithinWatermark([key])


def arrivals(events: DataFrame, kind: str, time: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by kind and window, and how many; with a watermark for late ones, so that a stream's state is bounded."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark(time, late)
    counted = timed.groupBy(F.window(time, size).alias("w"), kind).agg(F.count("*").alias("events"))
    return counted.select(F.col("w.start").alias("window_start"), kind, "events")
