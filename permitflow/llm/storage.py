"""Written intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir, shuffles_dropped


ROW_BITS = 40  # a file has less than 2**40 rows, a scan less than 2**23 files
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let tasks import this package wherever they run (once for each application)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="permitflow-py-"), "permitflow.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


class Scratch:
    """One run's folder of Parquet tables. A written table cuts lineage and survives lost executors.

    Tables that a returned DataFrame still reads stay; ``drop`` removes one that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        with shuffles_dropped(self.spark):
            df.write.mode("errorifexists").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def keyed(self, df: DataFrame) -> tuple[DataFrame, str]:
        """``df`` with a number of its own for each row, whatever its ids are, and the name of that column.

        Rows of Parquet files are numbered by file and place there, the same at each reading: nothing is copied. The driver
        lists the files of a scan to plan it, so their names fit there and in a broadcast. Any other table is written first.
        """
        row = "_row"
        while row in df.columns:
            row += "_"
        if df._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation" or not _has_row_index(df):
            return self.write(df.withColumn(row, F.monotonically_increasing_id()), "keyed"), row
        names = sorted(r[0] for r in df.select("_metadata.file_path").distinct().collect())
        files = self.spark.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(names)), "array<string>")).alias("file", "path"))
        number = F.shiftleft(F.col("file").cast("bigint"), ROW_BITS) + F.col("place.row_index")
        placed = df.select(F.struct(*df.columns).alias("row"), F.struct("_metadata.file_path", "_metadata.row_index").alias("place"))
        placed = placed.join(F.broadcast(files), F.col("place.file_path") == F.col("path"))
        return placed.select("row.*", number.alias(row)), row

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.path(name))

    def clear(self) -> None:
        """Deletes all tables of this run, when nothing reads them any more."""
        self._delete(self.root)

    def _delete(self, place: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _has_row_index(df: DataFrame) -> bool:
    try:
        return "row_index" in df.select("_metadata").schema["_metadata"].dataType.names
    except AnalysisException:
        return False
