"""What the allocation chain writes and deals: wide rows go by permit once, nothing is dealt by hydro group."""

import re

from permitflow.plans import common, v2
from permitflow import session

TAKES = ("RecordNumber string, take_type string, sw_allo_block string, WAP string, AllocatedRate double, WapRate double, VolumeDaily double, VolumeWeekly double, "
         "Volume30Day double, Volume150Day double, FromMonth string, ToMonth string, SD1 double, SD2 double, IncludeInSwAllocation string")


def _take(permit, site, kind="Take Groundwater", block="A"):
    return (permit, kind, block, site, 5.0, 5.0, 10.0, 70.0, 300.0, 1500.0, "Jul", "Jun", 1.0, 1.0, "yes")


def _tables(spark):
    takes = spark.createDataFrame([_take("P1", "LA01/0001"), _take("P1", "LA01/0001", "Take Surface Water"), _take("P1", None), _take("P2", "LA01/0001", block=None),
                                   _take("P2", "LA09/0009"), _take("P3", "LA01/0002"), _take("P4", "LA01/0001"), _take("P4", "nothing")], TAKES)
    permits = spark.createDataFrame([(p, "Issued - Active", None, None) for p in ("P1", "P2", "P3", "P4")], "RecordNumber string, ConsentStatus string, FromDate date, ToDate date")
    sites = spark.createDataFrame([("LA01/0001", 50, 45, True, "GWAZ1", "SWAZ1", False), ("LA01/0002", 95, 45, False, "GWAZ2", "SWAZ2", None)],
                                  "ExtSiteID string, SD1_7Day int, SD1_150Day int, Storativity boolean, GwSpatialUnitId string, SwSpatialUnitId string, Combined boolean")
    edges = spark.createDataFrame([("P1", "P3")], "ParentRecordNumber string, ChildRecordNumber string")
    return takes, permits, sites, edges


def _plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_take_rows_keep_null_sites_and_drop_unknown_ones(spark):
    takes, permits, sites, _ = _tables(spark)
    rows = common.take_rows(takes, permits.filter("RecordNumber <> 'P3'"), sites)
    assert sorted((r.RecordNumber, r.WAP or "") for r in rows.collect()) == [
        ("P1", ""), ("P1", "LA01/0001"), ("P1", "LA01/0001"), ("P2", "LA01/0001"), ("P4", ""), ("P4", "LA01/0001")]


def test_wide_take_rows_are_not_written(spark, monkeypatch):
    written, real = [], session.materialize

    def seen(df, name="stage"):
        written.append((name, df.columns))
        return real(df, name)
    monkeypatch.setattr(session, "materialize", seen)
    monkeypatch.setattr(common, "materialize", seen, raising=False)
    rows = v2.filled_rows(*_tables(spark))
    assert sorted((r.RecordNumber, r.WAP) for r in rows.collect())[:3] == [("P1", "LA01/0002")] * 3  # P1's from its relative
    assert written and all("VolumeDaily" not in columns for _, columns in written)


def test_inputs_are_dealt_by_permit_and_by_site_only(spark, capsys):
    takes, permits, sites, edges = _tables(spark)
    seasons = v2.seasonal_rates(takes, permits, sites, edges)
    flags = spark.createDataFrame([("P3", "Take Groundwater", None), ("P3", "Take Groundwater", True), ("P2", "Take Groundwater", True), ("P1", None, True)],
                                  "RecordNumber string, TakeType string, LowflowCondition boolean")
    inputs = v2.sd_rate_inputs(seasons, v2.waps_table(sites.unionByName(sites.withColumn("SD1_7Day", sites.SD1_7Day + 1))), flags)
    plan = _plan(inputs, capsys)
    assert not re.search(r"hashpartitioning\(RecordNumber#\d+, AllocationBlock", plan)  # before, the whole rows were
    rows = {(r.RecordNumber, r.AllocationBlock, r.Wap): r for r in inputs.collect()}
    assert len(rows) == inputs.count() == 4
    one = rows["P1", "A", "LA01/0002"]
    assert (one.TakeType, one.LowflowCondition, one.SD1_7Day, one.sd_cat) == ("Take Groundwater", False, 95, "direct")
    assert rows["P2", None, "LA01/0001"].LowflowCondition and not rows["P3", "A", "LA01/0002"].LowflowCondition


def test_allocation_is_not_dealt_by_hydro_group(spark, capsys):
    takes, permits, sites, edges = _tables(spark)
    waps = v2.waps_table(sites)
    flags = spark.createDataFrame([], "RecordNumber string, TakeType string, LowflowCondition boolean")
    inputs = session.materialize(v2.sd_rate_inputs(v2.seasonal_rates(takes, permits, sites, edges), waps, flags))
    volumes = spark.createDataFrame([("P1", "Take Groundwater", 1000, True, "A"), ("P1", "Take Groundwater", 500, False, "B"), ("P2", "Take Groundwater", 300, True, None)],
                                    "RecordNumber string, TakeType string, FullAnnualVolume long, IncludeInGwAllocation boolean, AllocationBlock string")
    out = v2.consented_allocation(None, waps, flags, volumes, permits, inputs=inputs)
    assert "HydroGroup#" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", _plan(out, capsys)))
    got = {(r.RecordNumber, r.AllocationBlock, r.HydroGroup, r.SpatialUnitId) for r in out.collect()}
    # P1's block B is left out of groundwater; P3 and P4 have no volume
    assert {g[0] for g in got} == {"P1", "P2"} and not any(g[1] == "B" and g[2] == "Groundwater" for g in got)


def test_an_allocation_of_a_site_and_day_counts_once(spark):
    from permitflow.catalog.q_domain import _allocations
    log = spark.sql("SELECT 'S' AS ExtSiteID, DATE '2024-01-10' AS RestrDate, CAST(id % 2 AS INT) AS Allocation, id AS event_id FROM range(10)")
    assert _allocations({"b_site_log": log}).count() == 2
