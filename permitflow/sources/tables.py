"""Table reads and writes.

Reads are declarative: the column list, ``IN`` lists and date ranges become a
projection and filters that Catalyst pushes into the parquet scan
(``ReadSchema`` / ``PushedFilters``), or into a JDBC query.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, src: str | DataFrame, cols: Sequence[str] | None = None,
               rename: Mapping[str, str] | None = None, where_in: Mapping[str, Sequence] | None = None,
               from_date: str | None = None, to_date: str | None = None, date_col: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Scan with a column list (back-quoted, so names with spaces
    or dots work), an optional rename map, ``IN`` predicates and an inclusive
    date range. ``src`` is a path, a catalog table name (``schema.table``) or a
    DataFrame."""
    if isinstance(src, DataFrame):
        df = src
    elif "/" in src or src.endswith(f".{fmt}"):
        df = spark.read.format(fmt).load(src)
    else:
        df = spark.table(src)
    if where_in:
        for c, values in where_in.items():
            if isinstance(values, DataFrame):
                # a list coming from another table: semi join, no driver round trip
                df = df.join(values.select(F.col(values.columns[0]).alias(c)).distinct(), c, "left_semi")
            else:
                df = df.filter(F.col(f"`{c}`").isin(list(values)))
    if date_col and (from_date or to_date):
        d = F.col(f"`{date_col}`")
        if from_date:
            df = df.filter(d >= F.lit(from_date).cast(df.schema[date_col].dataType))
        if to_date:
            df = df.filter(d <= F.lit(to_date).cast(df.schema[date_col].dataType))
    if cols:
        df = df.select(*[F.col(f"`{c}`") for c in cols])
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    return df


def catalog_table(df: DataFrame, schema: str, name: str, path: str) -> str:
    """``df`` saved as a table of the session catalog with its files under ``path``; returns its qualified name."""
    spark = df.sparkSession
    if not spark.catalog.databaseExists(schema):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` LOCATION '{path}/{schema}'")
    df.write.format("parquet").mode("overwrite").option("path", f"{path}/{schema}/{name}").saveAsTable(f"`{schema}`.`{name}`")
    return f"{schema}.{name}"


def load_new_days(feed: DataFrame, path: str, day: str, run_date: str, bootstrap: str = "1900-01-01") -> tuple[str, str] | None:
    """T1 on a table partitioned by day: the feed's days after the last loaded one, up to the run date, become partitions
    of ``path``. Other partitions are neither read nor written; a run that is repeated replaces its own.

    Where the feed is partitioned by day too, the window prunes its scan. Returns the window, None if caught up.
    """
    from ..operators.kept import path_exists
    from ..plans.timeseries import incremental_range, slice_range
    spark = feed.sparkSession
    loaded = spark.read.schema(feed.schema).parquet(path).select(day) if path_exists(spark, path) else None
    window = incremental_range(loaded, day, run_date, bootstrap)
    if window is not None:
        new = slice_range(feed, day, window).hint("rebalance", day)
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    return window


def high_water(df: DataFrame, col: str) -> DataFrame:
    """One row with ``max_<col>`` and ``min_<col>`` (parquet can answer
    from footers when aggregate pushdown is on)."""
    return df.agg(F.max(col).alias(f"max_{col}"), F.min(col).alias(f"min_{col}"))


def config_table(spark: SparkSession, rows: Sequence[Mapping], schema: str) -> DataFrame:
    """Small dimension from configuration lists; size is fixed by config,
    so broadcasting it is safe."""
    return F.broadcast(spark.createDataFrame([tuple(r.values()) for r in rows], schema))


def append(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """K1: append rows (daily facts partitioned by their date column)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """K6: full overwrite."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def stamp(df: DataFrame, run_ts: str, col: str = "ModifiedDate") -> DataFrame:
    """K9: stamp a run timestamp (injected, never ``current_timestamp()``)."""
    return df.withColumn(col, F.lit(run_ts).cast("timestamp_ntz"))


VERTEX_COLUMNS = ("zone_id", "ring", "seq", "x", "y")


def read_vertices(spark: SparkSession, src: str | DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Spatial table (zones or reaches) as vertex rows ``(zone_id, ring,
    seq, x, y)``; ``ring`` defaults to 0 for single-ring shapes. Geometry stays
    plain coordinate columns, ready for the G1/G2 grid joins."""
    df = src if isinstance(src, DataFrame) else spark.read.parquet(src)
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    if "ring" not in df.columns:
        df = df.withColumn("ring", F.lit(0))
    return df.select(F.col("zone_id").cast("string"), F.col("ring").cast("int"), F.col("seq").cast("int"),
                     F.col("x").cast("double"), F.col("y").cast("double"))
