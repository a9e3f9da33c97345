"""Streaming queries: the events table lands as files and is consumed by
Structured Streaming with ``availableNow`` (all arrived data, in bounded
micro-batches), so the result can be checked against a batch query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import Tables
from ..streaming import jobs
from .registry import query


LANDED_FILES = 8       # arrival layout: eight time-ordered files
FILES_PER_BATCH = 4    # micro-batch size: two batches, state carried across


def _landed_events(spark, d):
    e = Tables(spark, d).events
    landing = scratch_path(spark, "events_landing")
    jobs.stage_landing(e, landing, "ts", LANDED_FILES)
    return e.schema, landing


@query("stream_dedup_audit", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup_audit(spark, d):
    """First arrival of every (user, event type); later arrivals rejected."""
    schema, landing = _landed_events(spark, d)
    run = scratch_path(spark, "dedup_audit")
    return jobs.dedup_audit(spark, landing, schema, ["user_id", "event_type"], ["user_id", "event_type"],
                            f"{run}/sink", f"{run}/checkpoint", files_per_batch=FILES_PER_BATCH)


@query("stream_batch_copy", "SELECT event_id, user_id, event_type, value FROM events")
def stream_batch_copy(spark, d):
    """Copy every event into the target in micro-batches, idempotently."""
    schema, landing = _landed_events(spark, d)
    run = scratch_path(spark, "batch_copy")
    target = jobs.batch_copy(spark, landing, schema, ["event_id"], f"{run}/target", f"{run}/checkpoint",
                             files_per_batch=FILES_PER_BATCH)
    return target.select("event_id", "user_id", "event_type", "value")


@query("stream_batch_copy_nulls", """
SELECT DISTINCT ON (user_id, event_type) user_id, event_type FROM events
WHERE user_id % 5 <> 0 AND user_id IS NOT NULL AND event_type IS NOT NULL
UNION ALL
SELECT CASE WHEN user_id % 5 <> 0 THEN user_id END, event_type FROM events
WHERE user_id % 5 = 0 OR user_id IS NULL OR event_type IS NULL""")
def stream_batch_copy_nulls(spark, d):
    """The first copy of every key, and every row whose key has a NULL; a replay of all files adds nothing."""
    e = Tables(spark, d).events.select(F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id"), "event_type", "ts")
    landing, run = scratch_path(spark, "null_landing"), scratch_path(spark, "null_copy")
    jobs.stage_landing(e, landing, "ts", LANDED_FILES)
    schema = e.drop("ts").schema
    for attempt in ("first", "replay"):
        target = jobs.batch_copy(spark, landing, schema, ["user_id", "event_type"], f"{run}/target", f"{run}/{attempt}",
                                 files_per_batch=FILES_PER_BATCH)
    return target
