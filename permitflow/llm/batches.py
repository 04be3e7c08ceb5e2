"""Arrow batches inside tasks: sorted rows group by group, and bounded batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key as one table, from batches sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        values = keys.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        if held and held[-1].column(key)[0].as_py() != values[0]:
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for cut in cuts:
            held.append(batch.slice(start, cut - start))
            yield pa.Table.from_batches(held)
            held, start = [], cut
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def slices(batch: pa.RecordBatch, rows: int = 512, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``rows`` rows whose strings have at most ``size`` bytes together; a longer row is a part of its own."""
    total = np.zeros(batch.num_rows + 1, dtype=np.int64)  # bytes before each row
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
            total[1:] += np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        fits = int(np.searchsorted(total, total[start] + size, side="right")) - 1
        end = min(max(fits, start + 1), start + rows, batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` of a task, after which the memory it no longer uses goes back to the system: workers wait idle for later
    tasks, and allocators would keep for them what the largest batch had taken."""
    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()
    return tidied


def default_parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
