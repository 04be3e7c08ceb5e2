"""T5: the streamed block-restriction table equals the batch table."""

import datetime
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from permitflow.catalog.q_domain import RUN_DATE, WINDOW_START, _lowflow
from permitflow.plans.timeseries import block_restriction, restriction_feed, restriction_ts
from permitflow.plans.v1 import run_v1
from permitflow.session import materialize
from permitflow.streaming import read_block_restriction, start_restriction_stream
from permitflow.streaming.restrictions import merge_minima, write_batch

COLS = ["RecordNumber", "AllocationBlock", "ExtSiteID", "RestrDate", "Allocation"]


def test_stream_equals_batch(spark, tables):
    base = tempfile.mkdtemp(prefix="pf-stream-")
    src, sink, ckpt = (os.path.join(base, d) for d in ("src", "sink", "ckpt"))
    log = tables["b_site_log"].join(tables["events"].select("event_id", "ts"), "event_id")
    # one file per batch: the days in order, then late events of the first days, then events that came before
    days = F.dayofmonth("RestrDate")
    late = (days < 16) & (F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0)
    parts = [(days < 16) & ~late, days.between(16, 20), days > 20, late, days.between(10, 18)]
    for i, part in enumerate(parts):
        log.filter(part).coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
    permits = materialize(run_v1(tables)["permits"], "permits")
    cond = materialize(_lowflow(tables), "conditions")
    q = start_restriction_stream(spark, os.path.join(src, "*"), log.schema, permits, cond, sink, ckpt, RUN_DATE, WINDOW_START,
                                 files_per_batch=1)
    q.awaitTermination()
    # batch twin over all trigger bands (the stream uses the chosen bands only)
    feed = restriction_feed(log, tables["b_trigger"], permits, RUN_DATE, WINDOW_START)
    batch = block_restriction(restriction_ts(feed, permits, cond, RUN_DATE, WINDOW_START))
    want = sorted(map(tuple, batch.select(*COLS).collect()))
    assert want and sorted(map(tuple, read_block_restriction(spark, sink).select(*COLS).collect())) == want
    # a batch that runs again changes nothing
    files = spark.read.schema(log.schema).parquet(os.path.join(src, "part0"))
    write_batch(files, 99, permits, cond, sink, RUN_DATE, WINDOW_START)
    assert sorted(map(tuple, read_block_restriction(spark, sink).select(*COLS).collect())) == want


DDL = "RecordNumber string, AllocationBlock string, ExtSiteID string, RestrDate date, Allocation int"


def day(n):
    return datetime.date(2024, 1, n)


def content(spark, sink):
    return {(r.RecordNumber, r.RestrDate.day): r.Allocation for r in read_block_restriction(spark, sink).collect()}


def test_the_table_does_not_grow_with_batches(spark, tmp_path):
    sink = f"{tmp_path}/sink"
    first = spark.createDataFrame([(f"P{i}", "A", "S", day(1 + i % 3), 50 + i) for i in range(30)], DDL)
    merge_minima(spark, first, sink)
    want, files = content(spark, sink), len(spark.read.parquet(sink).inputFiles())
    for _ in range(50):
        merge_minima(spark, first, sink)
    assert content(spark, sink) == want and len(spark.read.parquet(sink).inputFiles()) <= files
    untouched = [f for f in spark.read.parquet(sink).inputFiles() if "RestrDate=2024-01-02" not in f]
    merge_minima(spark, spark.createDataFrame([("P1", "A", "S", day(2), 3), ("P4", "A", "S", day(2), 999), ("P7", "A", "S", day(2), None)], DDL), sink)
    assert content(spark, sink) == {**want, ("P1", 2): 3}
    assert set(untouched) <= set(spark.read.parquet(sink).inputFiles())
    merge_minima(spark, first.limit(0), sink)
    assert content(spark, sink) == {**want, ("P1", 2): 3}


def test_a_run_that_died_between_its_steps_is_finished(spark, tmp_path):
    sink = f"{tmp_path}/sink"
    merge_minima(spark, spark.createDataFrame([("P1", "A", "S", day(1), 5), ("P1", "A", "S", day(2), 6)], DDL), sink)
    ready = spark.createDataFrame([("P1", "A", "S", day(1), 4), ("P2", "A", "S", day(1), 7)], DDL)
    ready.write.partitionBy("RestrDate").parquet(f"{sink}/_pending")
    shutil.rmtree(f"{sink}/RestrDate=2024-01-01")
    merge_minima(spark, spark.createDataFrame([("P1", "A", "S", day(3), 1)], DDL), sink)
    assert content(spark, sink) == {("P1", 1): 4, ("P2", 1): 7, ("P1", 2): 6, ("P1", 3): 1} and not os.path.exists(f"{sink}/_pending")
    # a folder that was not finished holds nothing that counts
    ready.write.partitionBy("RestrDate").parquet(f"{sink}/_pending")
    os.remove(f"{sink}/_pending/_SUCCESS")
    assert content(spark, sink)["P1", 1] == 4 and not os.path.exists(f"{sink}/_pending")
