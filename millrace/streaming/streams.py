"""Micro-batch state: rounds over new files, change detection, first content, status rules, and windows on event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Seconds within which a heartbeat is fresh.
FRESH_WORKER, FRESH_HOST = 1500, 300


def read_folder(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files: int = 1000) -> DataFrame:
    """New files of a folder per round; what has been read is in the checkpoint."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files).load(path)


def run_round(out: DataFrame, checkpoint: str, sink: str, table: str, mode: str = "complete") -> StreamingQuery:
    """One round over all that is new, then stop."""
    return out.writeStream.format(sink).queryName(table).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def incremental_totals(stream: DataFrame, by: list[str], size: str) -> DataFrame:
    """Counts and sums per group, kept in the aggregation store across rounds."""
    return stream.groupBy(*by).agg(F.count("*").alias("n"), F.sum(size).alias("size"))


def first_per_content(stream: DataFrame, content: str, at: str | None = None, late: str = "1 day") -> DataFrame:
    """Each content once. With an event time the state is bounded by the watermark."""
    if at is None:
        return stream.dropDuplicates([content])
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([content])


def each_batch(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """A batch function per round; repeated for a round that failed, so `step` must be idempotent by its number."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changed(listing: DataFrame, seen: DataFrame, key: str, tag: str) -> DataFrame:
    """Keys that are new or carry another tag."""
    return listing.join(seen.select(key, tag), [key, tag], "left_anti")


def alive(beat: Column, now: Column, seconds: int = FRESH_WORKER) -> Column:
    return F.coalesce(F.unix_timestamp(now) - F.unix_timestamp(beat) < seconds, F.lit(False))


def next_status(status: Column, attempts: Column, memory_killed: Column, size_class: Column, largest: str = "large", most: int = 3) -> Column:
    """done stays; a memory kill goes to the larger class while there is one; other failures are tried again up to `most` times."""
    return (
        F.when(status == "done", "done")
        .when((status == "failed") & memory_killed & (size_class != largest), "escalate")
        .when((status == "failed") & (attempts < most), "retry")
        .when(status == "failed", "given_up")
        .otherwise(status)
    )


def may_finish(queued: int, in_flight: int, last_delta: float, drained_at: float | None) -> bool:
    """Final only when all queues are empty and the deltas are newer than the moment they ran dry."""
    return queued == 0 and in_flight == 0 and drained_at is not None and last_delta > drained_at


def tumbling(events: DataFrame, at: str, width: str, late: str | None = None, by: list[str] = ()) -> DataFrame:
    """Counts per window of event time; on a stream late rows beyond the watermark are left out. An extension."""
    src = events.withWatermark(at, late) if late else events
    return src.groupBy(F.window(at, width), *by).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value")).select(F.col("window.start").alias("start"), *by, "n", "value")


def sessions(events: DataFrame, at: str, gap: str, by: list[str], late: str | None = None) -> DataFrame:
    """Sessions by a gap of event time. An extension."""
    src = events.withWatermark(at, late) if late else events
    return src.groupBy(F.session_window(at, gap), *by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("stop"), *by, "n")
