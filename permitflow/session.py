"""Session helpers: one place for the runtime settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime (broadcast of
# small sides only when their *measured* size is under the threshold, skew
# splitting of hot partitions, coalescing of small shuffle partitions).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "permitflow", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only when nothing is configured (local tests) a scratch folder is
    created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        # local runs (tests) only: a scratch folder on this machine
        conf_dir = tempfile.mkdtemp(prefix="permitflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries begun here leave no shuffle files: these go when the query ends, not when the driver happens to collect garbage.

    Only for queries whose result is kept, as by a write: each reads its shuffles itself, and no other does."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def materialize(df, name: str = "stage"):
    """Write a pipeline stage once as a parquet table in the shared checkpoint
    folder and read it back.

    Every consumer then reads the written copy (with column pruning and filter
    pushdown) instead of recomputing the upstream plan, AQE sees the real file
    sizes when it picks join strategies, and a lost executor recomputes from
    the written stage, not from the sources. This is the "written table" form
    of a reliable checkpoint; ``localCheckpoint`` is never used.
    """
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"permitflow/{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(spark):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def materialize_counted(df, name: str, **counts):
    """``materialize``, and the values of the aggregates ``counts`` as observed by that write (null sums as 0)."""
    from pyspark.sql import Observation, functions as F
    seen = Observation()
    out = materialize(df.observe(seen, *[F.coalesce(c, F.lit(0)).alias(k) for k, c in counts.items()]), name)
    return out, {k: seen.get[k] for k in counts}
