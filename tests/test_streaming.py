from pyspark.sql import functions as F

from conftest import rows
from relkit.session import scratch_path
from relkit.streaming import jobs

SCHEMA = "event_id long, user_id long, kind string"


def _land(spark, landing, batches):
    for i, data in enumerate(batches):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(landing)


def test_dedup_audit_rejects_keys_seen_in_earlier_batches(spark):
    run = scratch_path(spark, "t_dedup")
    _land(spark, f"{run}/landing", [[(1, 10, "a"), (2, 11, "a")], [(3, 10, "a"), (4, 12, "b")],
                                    [(5, 12, "b"), (6, 11, "b")]])
    schema = spark.read.parquet(f"{run}/landing").schema
    out = jobs.dedup_audit(spark, f"{run}/landing", schema, ["user_id", "kind"], ["user_id", "kind"],
                           f"{run}/sink", f"{run}/ck")
    assert rows(out) == [(10, "a"), (11, "a"), (11, "b"), (12, "b")]


def test_batch_copy_is_incremental_and_idempotent(spark):
    run = scratch_path(spark, "t_copy")
    landing = f"{run}/landing"
    _land(spark, landing, [[(1, 10, "a"), (2, 11, "a")], [(2, 11, "a"), (3, 12, "b")]])
    schema = spark.read.parquet(landing).schema
    out = jobs.batch_copy(spark, landing, schema, ["event_id"], f"{run}/target", f"{run}/ck")
    assert rows(out, "event_id") == [(1,), (2,), (3,)]
    # New data arrives; the same checkpoint resumes after the committed batches.
    _land(spark, landing, [[(4, 13, "c")]])
    out = jobs.batch_copy(spark, landing, schema, ["event_id"], f"{run}/target", f"{run}/ck")
    assert rows(out, "event_id") == [(1,), (2,), (3,), (4,)]
    # A replay from scratch (lost checkpoint) appends nothing twice.
    out = jobs.batch_copy(spark, landing, schema, ["event_id"], f"{run}/target", f"{run}/ck2")
    assert out.count() == 4 and out.select(F.countDistinct("event_id")).first()[0] == 4


def test_dedup_audit_with_watermark_bounds_state(spark):
    import datetime as dt
    run = scratch_path(spark, "t_dedup_wm")
    t0 = dt.datetime(2024, 1, 1)
    schema = "event_id long, user_id long, kind string, ts timestamp"
    for data in ([(1, 10, "a", t0), (2, 11, "a", t0)], [(3, 10, "a", t0 + dt.timedelta(minutes=1))]):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{run}/landing")
    sch = spark.read.parquet(f"{run}/landing").schema
    out = jobs.dedup_audit(spark, f"{run}/landing", sch, ["user_id", "kind"], ["user_id", "kind"],
                           f"{run}/sink", f"{run}/ck", watermark=("ts", "1 hour"))
    assert rows(out) == [(10, "a"), (11, "a")]
