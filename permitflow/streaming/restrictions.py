"""T5: the daily block restriction table maintained by a stream.

Source: site-log files arriving in a folder (file source, fixed schema).
Each micro-batch runs the batch operators (T2 restriction rows within permit
validity and run window, T4 minimum per permit x block x site x day) and merges
its minima into the table, which is partitioned by day: only the days that the
batch touches are read and rewritten, from old and new minima. The minimum is
idempotent and associative, so neither state nor a watermark is needed, no row is
dropped, and the table does not grow with the number of batches:

* an event that arrives twice, or a batch that runs again, changes nothing,
* a late measurement, however old, simply lowers its day's minimum.

The rewritten days are first written to a folder beside the table, then take the
place of the old ones. If a run dies in between, the next batch finishes that step
before its own, so no day is lost. The result equals the batch table on the same
input. ``availableNow`` processes what has arrived and stops, which fits a
scheduled job; a continuous trigger works the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.aggregate import group_min
from ..operators.kept import delete_path, path_exists
from ..plans.timeseries import block_restriction, restriction_feed, restriction_ts
from ..session import materialize

KEYS = ["RecordNumber", "AllocationBlock", "ExtSiteID", "RestrDate"]
_PENDING = "_pending"  # Spark's readers pass over names that begin with an underscore


def _finish(spark: SparkSession, sink_dir: str) -> None:
    """Puts days that are ready beside the table into their place."""
    ready = f"{sink_dir}/{_PENDING}"
    if path_exists(spark, f"{ready}/_SUCCESS"):
        (spark.read.parquet(ready).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("RestrDate").parquet(sink_dir))
    delete_path(spark, ready)


def merge_minima(spark: SparkSession, minima: DataFrame, sink_dir: str) -> None:
    """Lowers the table's minima by those of ``minima``; days that it does not touch are neither read nor written."""
    _finish(spark, sink_dir)
    new = materialize(minima.select(*KEYS, "Allocation"), "batch-minima")
    days = [r[0] for r in new.select("RestrDate").distinct().collect()]  # days of the run window
    if not days:
        return
    table = spark.read.schema(new.schema).parquet(sink_dir) if path_exists(spark, sink_dir) else new.limit(0)
    old = table.filter(F.col("RestrDate").isin(days))
    merged = group_min(old.unionByName(new), KEYS, ["Allocation"]).hint("rebalance", "RestrDate")
    merged.write.mode("overwrite").partitionBy("RestrDate").parquet(f"{sink_dir}/{_PENDING}")
    _finish(spark, sink_dir)


def write_batch(batch: DataFrame, batch_id: int, permits: DataFrame, conditions: DataFrame, sink_dir: str,
                run_date: str, window_start: str) -> None:
    """Merges one micro-batch into the table."""
    feed = restriction_feed(batch, conditions, permits, run_date, window_start)
    restr = restriction_ts(feed, permits, conditions, run_date, window_start)
    merge_minima(permits.sparkSession, block_restriction(restr), sink_dir)


def start_restriction_stream(spark: SparkSession, source_dir: str, schema, permits: DataFrame,
                             conditions: DataFrame, sink_dir: str, checkpoint_dir: str, run_date: str,
                             window_start: str, available_now: bool = True,
                             files_per_batch: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, permits, conditions, sink_dir, run_date, window_start)

    writer = reader.parquet(source_dir).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_block_restriction(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The table as it stands: a row for each permit, block, site and day."""
    _finish(spark, sink_dir)
    return spark.read.parquet(sink_dir)
