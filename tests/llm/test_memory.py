"""What executors hold and start beside the work itself stays bounded."""

import pyarrow as pa
import pytest

from relkit.llm import components, packing, util

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def dealt_out(spark):
    """Every shuffle deals to 211 partitions, however small the table."""
    held = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def batch_bytes(spark):
    def sizes(batches):
        for rb in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rb.nbytes])], names=["n"])

    rows = spark.range(0, 5000, 1, 1).selectExpr("id", "repeat('x', 4000) AS text")
    return [r["n"] for r in rows.mapInArrow(sizes, "n long").collect()]


def test_batches_of_long_texts_are_bounded(spark):
    spark.conf.unset(LIMIT)
    util.prepare(spark)
    assert max(batch_bytes(spark)) < 2 * util.BATCH_BYTES


def test_a_limit_of_the_caller_stays(spark):
    spark.conf.set(LIMIT, "1m")
    try:
        util.prepare(spark)
        assert spark.conf.get(LIMIT) == "1m"
        assert max(batch_bytes(spark)) < 2 << 20
    finally:
        spark.conf.unset(LIMIT)


def test_small_tables_go_into_few_files(spark, monkeypatch):
    few = util.FILES_PER_CORE * spark.sparkContext.defaultParallelism
    df = spark.range(0, 5000).repartition(3 * few)
    small = util.stored(df, "test-few", 5000)
    assert len(small.inputFiles()) <= few
    assert sorted(r["id"] for r in small.collect()) == list(range(5000))
    # More rows go into more files; without a bound every partition is a file.
    monkeypatch.setattr(util, "FILE_ROWS", 5000 // (2 * few))
    assert few < len(util.stored(df, "test-more", 5000).inputFiles()) < 3 * few
    assert len(util.stored(df, "test-all").inputFiles()) == 3 * few


def test_components_of_few_edges_go_into_few_files(spark, dealt_out):
    edges = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(400)] + [(k, k + 100) for k in range(100)], "a long, b long")
    found = components.components(edges, rows=500)
    assert len(set(found.inputFiles())) <= util.FILES_PER_CORE * spark.sparkContext.defaultParallelism
    root = {r["node"]: r["root"] for r in found.collect()}
    assert len(root) == 800 and all(root[2 * k] == root[2 * k + 1] for k in range(400))
    assert all(root[k] == root[k + 100] for k in range(100))


def test_packing_starts_no_second_set_of_python_workers(spark):
    pieces = spark.createDataFrame([(k, 1 + k % 7) for k in range(50)], "id long, length long")
    placed = packing.place(util.stored(pieces, "test-pieces"), 10)
    assert "ExistingRDD" not in placed._jdf.queryExecution().executedPlan().toString()
    assert placed.count() == 50
    assert packing.place(util.stored(pieces.limit(0), "test-none"), 10).collect() == []
