import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from permitflow.session import BASE_CONF
    b = SparkSession.builder.master("local[*]").appName("permitflow-tests").config("spark.sql.shuffle.partitions", "8")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pf-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from permitflow.sources.bindings import Tables
    return Tables(spark, SMOKE_DIR)


@pytest.fixture(scope="session")
def spark_session_for_props(spark):
    return spark
