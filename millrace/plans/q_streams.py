"""Batch twins of the streams, and a stream run to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.session import load, shared_dir
from millrace.streaming import streams


def _events(spark, d):
    return load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream1_totals", "SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS size FROM events GROUP BY 1")
def stream1(spark, d):
    """A stream of the events' files in rounds until none is new; its state is returned."""
    import uuid

    src = load(spark, d, "events")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema)
    name = f"totals_{uuid.uuid4().hex}"
    path = f"{d}/events.parquet"
    stream = streams.read_folder(spark, path if not _is_file(spark, path) else f"{d}/event[s].parquet", schema)
    streams.run_round(streams.incremental_totals(stream, ["event_type"], "user_id"), f"{shared_dir(spark)}/{name}", "memory", name).awaitTermination()
    return spark.table(name)


def _is_file(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


@query("stream2_tumbling", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def stream2(spark, d):
    out = streams.tumbling(_events(spark, d), "ts", "1 day", by=["event_type"])
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    "stream3_sessions",
    """WITH n AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 2 HOUR THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM n)
    SELECT min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS stop, user_id, count(*) AS n FROM i GROUP BY user_id, s""",
)
def stream3(spark, d):
    out = streams.sessions(_events(spark, d), "ts", "2 hours", ["user_id"])
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "stop")})


@query(
    "stream4_status",
    "SELECT event_type, CASE WHEN event_type = 'purchase' THEN 'done' WHEN event_type = 'error' AND value > 50 AND user_id % 3 <> 0 THEN 'escalate' WHEN event_type = 'error' AND event_id % 5 < 3 THEN 'retry' WHEN event_type = 'error' THEN 'given_up' ELSE 'queued' END AS next, count(*) AS n FROM events GROUP BY 1, 2",
)
def stream4(spark, d):
    c = F.col
    status = F.when(c("event_type") == "purchase", "done").when(c("event_type") == "error", "failed").otherwise("queued")
    step = streams.next_status(status, c("event_id") % 5, c("value") > 50, F.when(c("user_id") % 3 == 0, "large").otherwise("small"))
    return load(spark, d, "events").groupBy("event_type", step.alias("next")).agg(F.count("*").alias("n"))


@query("stream5_alive", "SELECT user_id, max(ts) AS beat, epoch(TIMESTAMP '2024-01-30 12:00:00') - floor(epoch(max(ts))) < 86400 AS alive FROM events GROUP BY 1")
def stream5(spark, d):
    beat = _events(spark, d).groupBy("user_id").agg(F.max("ts").alias("beat"))
    return beat.select("user_id", F.col("beat").cast("timestamp_ntz").alias("beat"), streams.alive(F.col("beat"), F.lit("2024-01-30 12:00:00").cast("timestamp"), 86400).alias("alive"))
