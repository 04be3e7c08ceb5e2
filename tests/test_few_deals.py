"""What the chain's last steps deal and write: a permit's rows go by permit once, few rows are known to be few."""

import re
import time

from pyspark.sql import functions as F

from permitflow import session
from permitflow.operators.reshape import to_long
from permitflow.operators.sync import assign_ids, assign_ids_once
from permitflow.plans import legacy, limits, reporting, v1, v2

from test_dealing import _plan
from test_legacy import GW, SPLIT, SW, VOLUMES
from test_one_deal import _deals


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return len(re.findall(r"shuffle_\d+_\d+_\d+", manager.getAllFiles().mkString(" ")))


def test_a_written_stage_leaves_no_shuffles(spark):
    rows = spark.range(1000).repartition(4).groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("v")).repartition(5, "v")
    spark._jvm.System.gc()
    time.sleep(1)
    before = _shuffle_files(spark)
    out = session.materialize(rows)
    for _ in range(50):  # files go in the background
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before and out.count() == 7
    assert spark.conf.get(session._DROP_SHUFFLES, "false") == "false"


def test_legacy_volumes_deal_by_permit_only(spark, capsys):
    split = spark.createDataFrame([("P1", GW, "A", "W1", 0.5, 10.0, 30.0, 1, 12), ("P1", SW, "B", "W2", 1.0, 5.0, 0.0, 1, 12), ("P2", GW, "A", "W3", 0.0, None, 2.0, 1, 12),
                                   ("P3", GW, None, "W4", 0.0, 1.0, 2.0, 1, 12), (None, GW, "A", "W5", 0.0, 1.0, 2.0, 1, 12)], SPLIT).repartition("RecordNumber")
    volumes = spark.createDataFrame([("P1", GW, "A", 1000.0), ("P1", None, "C", 60.0), ("P2", SW, "B", 70.0), ("P2", SW, None, 5.0), ("P3", SW, "D", 9.0), ("P4", SW, "D", 9.0),
                                     (None, SW, "D", 9.0)], VOLUMES)
    out = legacy.legacy_volumes(split, volumes)
    assert set(_deals(out, capsys)) == {"RecordNumber"}
    rows = {(r.RecordNumber, r.AllocationBlock, r.HydroGroup, r.WAP): (r.Source, r.AllocatedAnnualVolume) for r in out.collect()}
    assert rows["P1", "A", "Groundwater", "W1"] == ("both", 500.0) and rows["P1", "C", "Groundwater", "W1"] == ("rerouted", 60.0)
    assert rows["P2", "B", "Surface Water", None] == ("rerouted", 70.0)  # no site of the permit has surface water
    assert rows["P3", "D", "Surface Water", "W4"] == ("rerouted", 9.0) and not any(k[0] in (None, "P4") or k[1] is None for k in rows)


def test_long_rows_stay_dealt(spark, capsys):
    df = spark.createDataFrame([("P1", "U", "W", "x", None), ("P2", "U", "W", "y", "3")], "RecordNumber string, UseType string, WAP string, WaterUse string, IrrigationArea string")
    long = to_long(df.repartition("RecordNumber"), ["RecordNumber", "UseType", "WAP"], ["WaterUse", "IrrigationArea"], "Attribute", "Value")
    out = reporting.use_attributes(long)
    assert _deals(out, capsys) == ["RecordNumber"]
    assert {(r.RecordNumber, r.WaterUse, r.IrrigationArea) for r in out.collect()} == {("P1", "x", 0.0), ("P2", "y", 3.0)}


def test_consented_rows_meet_months_by_permit(spark, capsys):
    consented = spark.createDataFrame([("P1", "Take Groundwater", 10.0, None, None, None, None), (" p1", "take groundwater", 6.0, 4.0, 1.0, 8.0, "yes"), ("P1", None, 5.0, None, None, None, None),
                                       ("P2", "Take Groundwater", 5.0, None, None, None, None)], "RecordNumber string, take_type string, ConsentedRate double, ConsentedMultiDayVolume double, "
                                      "ConsentedMultiDayPeriod double, ConsentedAnnualVolume double, LowflowCondition string")
    months = spark.createDataFrame([("P1", "Take Groundwater", "S1", 1, 12, 2), ("P1", "Take Groundwater", "S2", 1, 6, 2), ("P1", None, "S3", 1, 2, None), ("P1", "Take Surface Water", "S4", 1, 2, 1)],
                                   "RecordNumber string, take_type string, WAP string, FromMonth int, ToMonth int, wap_count long")
    out = v1.consented_rate_volume(consented, months, spark.createDataFrame([("P1",)], "RecordNumber string"))
    assert set(_deals(out, capsys)) <= {"RecordNumber"}
    assert sorted((r.WAP, r.ConsentedRate, r.ConsentedMultiDayVolume, r.ToMonth) for r in out.collect()) == [("S1", 3.0, 2.0, 12), ("S1", 5.0, None, 12), ("S2", 3.0, 2.0, 6), ("S2", 5.0, None, 6)] \
        or sorted((r.WAP, r.ConsentedRate) for r in out.collect()) == [("S1", 3.0), ("S1", 5.0), ("S2", 3.0), ("S2", 5.0)]


def test_the_allocation_is_summed_by_zone_before_it_is_written(spark, monkeypatch):
    written, real = {}, session.materialize
    monkeypatch.setattr(v2, "materialize", lambda df, name="stage": written.update({name: real(df, name)}) or written[name])
    alloc = spark.createDataFrame([("Surface Water", False, s, z, "A", m, 12, 10) for s in ("Issued - Active", "Application in Process", "Surrendered") for z in ("Z1", None) for m in (1, 4, 4)],
                                  "HydroGroup string, Combined boolean, ConsentStatus string, SpatialUnitId string, AllocationBlock string, FromMonth int, ToMonth int, AllocatedRate long")
    got = {(r.SpatialUnitId, r.Month): (r.AllocatedRate, r.NewAllocationInProgress) for r in v2.sw_zone_allocation(alloc).collect()}
    assert got["Z1", 3] == (10, 10) and got["Z1", 12] == (20, 20) and got[None, 12] == (20, None) and len(got) == 24
    assert list(written) == ["sw-zone-sums"] and written["sw-zone-sums"].count() == 8  # two months, statuses and zones each
    months = {(r.SpatialUnitId, r.Month): r.AllocatedRate for r in v2.sw_zone_allocation(alloc, active_months=True).collect()}
    assert months["Z1", 1] == 10 and months["Z1", 12] == 30


def test_zone_names_are_known_to_be_few(spark, capsys):
    alloc = spark.createDataFrame([("P1", "Z1"), ("P2", "Z2"), ("P3", None)], "RecordNumber string, SpatialUnitId string").repartition("RecordNumber")
    names = spark.createDataFrame([("Z1", "N"), ("Z1", "N"), ("Z1", "M")], "SpatialUnitId string, Name string").repartition("Name")
    out = limits.consent_zone_names(alloc, names)
    assert "SpatialUnitId" not in "".join(_deals(out, capsys)) or "BroadcastHashJoin" in _plan(out, capsys)
    assert len(re.findall(r"Exchange hashpartitioning\(SpatialUnitId#\d+, \d+\)", _plan(out, capsys))) == 0
    assert sorted((r.RecordNumber, r.SpatialUnitName) for r in out.collect()) == [("P1", "M"), ("P1", "N")]


def test_rows_numbered_themselves_have_the_ids_of_their_keys(spark):
    df = spark.createDataFrame([(a, b, f"{a}{b}") for a in ("x", "y", None) for b in (3, 1, None)], "a string, b int, v string")
    some = spark.createDataFrame([("y", 3, 40), (None, 1, 2)], "a string, b int, id long")
    for existing in (None, some):
        want, got = assign_ids(df, ["a", "b"], existing), assign_ids_once(df, ["a", "b"], existing)
        assert got.columns == ["a", "b", "v", "id"] and sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_lowflow_sites_lie_beside_their_conditions(spark, capsys):
    triggers = spark.createDataFrame([("P1", "1", 1, 5, 9, True), ("P1", "1", 2, 5, 9, True), ("P1", "2", 3, 6, 8, False), ("P2", "1", 1, 1, 2, True), ("P3", "1", 1, 1, 2, True)],
                                     "RecordNumber string, ExtSiteID string, BandNumber int, MinAllocation int, MaxAllocation int, IsActive boolean")
    allo = spark.createDataFrame([("P1", "A", "Surface Water"), ("P1", "B", "Surface Water"), ("P1", "C", "Surface Water"), ("P2", "A", "Groundwater")], "RecordNumber string, AllocationBlock string, HydroGroup string")
    blocks = spark.createDataFrame([(1, "A", "Surface Water"), (2, "B", "Surface Water"), (4, "A", "Groundwater")], "AlloBlockID int, AllocationBlock string, HydroGroup string")
    sites = spark.createDataFrame([(7, "1", "LowFlow"), (7, "1", "Residual"), (8, "2", "LowFlow")], "SiteID long, ExtSiteID string, SiteType string")
    ids, conditions = v1.lowflow_by_register(triggers, allo, blocks, sites)
    want = ids.join(conditions, "CrcAlloSiteID")
    got = v1.lowflow_with_sites(v1.lowflow_register_rows(triggers, allo, blocks, sites))
    assert got.drop("ExtSiteID").columns == want.columns and got.drop("ExtSiteID").exceptAll(want).count() == want.exceptAll(got.drop("ExtSiteID")).count() == 0
    # a site that the register has twice: two rows, each with its two conditions, which meet again
    found = {}
    for r in want.collect():
        found[r.RecordNumber, r.AlloBlockID, r.SiteID, r.BandNumber] = found.get((r.RecordNumber, r.AlloBlockID, r.SiteID, r.BandNumber), 0) + 1
    assert found == {("P1", 1, 7, 1): 8, ("P1", 2, 7, 1): 8, ("P1", 1, 8, 3): 1, ("P1", 2, 8, 3): 1, ("P2", 9, 7, 1): 8}
    assert set(_deals(got, capsys)) == {"_pid"}  # the counts of the numbered parts alone


def test_lowflow_conditions_are_made_once(spark, monkeypatch):
    written, real = [], session.materialize
    monkeypatch.setattr(reporting, "materialize", lambda df, name="stage": written.append(name) or real(df, name))
    made = spark.sparkContext.accumulator(0)
    cond = spark.createDataFrame([("P1", "A", "S1", 1, 5, 9), ("P2", "A", "S1", 2, 6, 8), (None, "A", "S1", 2, 6, 8)],
                                 "RecordNumber string, AllocationBlock string, ExtSiteID string, BandNumber int, MinAllocation int, MaxAllocation int")
    seen = F.udf(lambda b: made.add(1) or b, "int").asNondeterministic()
    sites, by_id = reporting.lowflow_by_id(cond.withColumn("BandNumber", seen("BandNumber")))
    out = reporting.lowflow_summary(sites, by_id)
    assert sorted((r.RecordNumber, r.BandNumber) for r in out.collect()) == [("P1", 1), ("P2", 2)] and sites.count() == 3
    assert made.value == 3 and written == ["conditions"]
