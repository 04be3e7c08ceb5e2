"""Unit tests for operators that have no query key of their own (SURVEY §2 rows marked '-')."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from permitflow.functions.measures import available, finite_or_zero, percent, rate_to_volume, volume_to_rate
from permitflow.operators.aggregate import observed_counts
from permitflow.operators.clean import round_int, with_constants, keep_any_positive
from permitflow.operators.quality import check_codes
from permitflow.operators.sync import delete_keys, error_log_row
from permitflow.plans.reporting import consent_document
from permitflow.sources.tables import append, config_table, overwrite, read_table, stamp


def test_append_overwrite_roundtrip(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pf-sink-"), "t")
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, v int")
    overwrite(df, path, partition_by=["d"])
    append(df.withColumn("v", F.col("v") + 10), path, partition_by=["d"])
    back = read_table(spark, path, cols=["d", "v"], where_in={"d": ["2024-01-02"]})
    assert sorted(r["v"] for r in back.collect()) == [2, 12]
    overwrite(df, path)
    assert spark.read.parquet(path).count() == 2


def test_config_table_and_constants(spark):
    dim = config_table(spark, [{"HydroGroup": "Surface Water"}, {"HydroGroup": "Groundwater"}], "HydroGroup string")
    out = with_constants(stamp(dim, "2020-07-01 00:00:00"), {"SiteType": "WAP"})
    rows = out.collect()
    assert {r["HydroGroup"] for r in rows} == {"Surface Water", "Groundwater"}
    assert all(r["SiteType"] == "WAP" and r["ModifiedDate"].year == 2020 for r in rows)


def test_round_and_finite(spark):
    df = spark.createDataFrame([(2.5, float("inf")), (3.5, float("nan")), (1.4, None), (-2.5, 4.0)], "x double, y double")
    got = round_int(df, ["x"]).select("x", finite_or_zero("y").alias("y")).collect()
    assert [r["x"] for r in got] == [2, 4, 1, -2]
    assert [r["y"] for r in got] == [0.0, 0.0, 0.0, 4.0]


def test_rates_and_views(spark):
    df = spark.createDataFrame([(86400.0, 1.0, 0, 5), (864.0, 2.0, 100, 25)], "v double, r double, lim long, used long")
    got = df.select(volume_to_rate("v", days=1).alias("a"), rate_to_volume("r", days=1).alias("b"),
                    available("lim", "used").alias("c"), percent("lim", "used").alias("d")).collect()
    assert got[0]["a"] == pytest.approx(1000.0) and got[1]["b"] == pytest.approx(172.8)
    assert (got[0]["c"], got[0]["d"]) == (0, 0) and (got[1]["c"], got[1]["d"]) == (75, 25)


def test_observed_counts_no_second_pass(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 3)
    obs_df, obs = observed_counts(keep_any_positive(df, ["x"]), "positive")
    obs_df.write.mode("overwrite").format("noop").save()
    assert obs.get["rows"] == 66


def test_check_codes(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,), ("Z",)], "c string")
    assert [r["c"] for r in check_codes(df, "c", {"k": ["A", "B"]}).collect()] == ["Z"]


def test_delete_cascade_and_error_row(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    child = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "pid int, v string")
    gone = spark.createDataFrame([(2,)], "id int")
    p2, (c2,) = delete_keys(parent, gone, "id", cascade=[(child, "pid")])
    assert sorted(r["id"] for r in p2.collect()) == [1, 3]
    assert [r["v"] for r in c2.collect()] == ["a"]
    row = error_log_row(spark, "2020-07-01 00:00:00", "Permit", ValueError("x" * 500)).first()
    assert row["RunResult"] == "fail" and len(row["Comment"]) == 500


def test_consent_document(spark):
    alloc = spark.createDataFrame([
        ("CRC1", "Groundwater", "A", "L1", 5, 100), ("CRC1", "Groundwater", "B", "L1", 1, 10),
        ("CRC1", "Surface Water", "A", "L2", 2, 20), ("CRC2", "Groundwater", "A", "L3", 3, 30)],
        "RecordNumber string, HydroGroup string, AllocationBlock string, Wap string, AllocatedRate int, AllocatedAnnualVolume int")
    docs = {r["RecordNumber"]: r["document"] for r in consent_document(alloc).collect()}
    assert docs["CRC1"]["Groundwater"]["B"]["L1"]["AllocatedAnnualVolume"] == 10
    assert set(docs["CRC1"]) == {"Groundwater", "Surface Water"} and set(docs["CRC2"]["Groundwater"]) == {"A"}


def test_read_vertices(spark, tables):
    from permitflow.sources.tables import read_vertices
    v = read_vertices(spark, tables["b_reach_vertex"], rename={"reach_id": "zone_id", "vertex_id": "seq"})
    assert v.columns == ["zone_id", "ring", "seq", "x", "y"] and v.count() == tables["b_reach_vertex"].count()
