"""The permit chain deals its rows by permit once: what groups or joins them by more than the permit finds them in place."""

import re

from pyspark.sql import functions as F

from permitflow.operators.hierarchy import nearest_relative_value
from permitflow.plans import legacy, v1, v2
from permitflow.sources.bindings import _SQL, Tables

from test_dealing import _plan, _tables

DEALT = r"hashpartitioning\(([^)]*)\)"


def _deals(df, capsys):
    return [re.sub(r"#\d+|, \d+$", "", d) for d in re.findall(DEALT, _plan(df, capsys))]


def test_allocation_deals_its_inputs_by_permit_only(spark, capsys):
    takes, permits, sites, edges = _tables(spark)
    flags = spark.createDataFrame([], "RecordNumber string, TakeType string, LowflowCondition boolean")
    volumes = spark.createDataFrame([("P1", "Take Groundwater", 1000, True, "A"), ("P1", "Take Groundwater", 500, True, None), ("P2", "Take Groundwater", 300, True, None)],
                                    "RecordNumber string, TakeType string, FullAnnualVolume long, IncludeInGwAllocation boolean, AllocationBlock string")
    out = v2.consented_allocation(v2.seasonal_rates(takes, permits, sites, edges), v2.waps_table(sites), flags, volumes, permits)
    assert set(_deals(out, capsys)) <= {"RecordNumber", "Wap", "RecordNumber, TakeType"}  # the last: the flags alone
    got = {(r.RecordNumber, r.AllocationBlock, r.HydroGroup): r.AllocatedAnnualVolume for r in out.collect()}
    # a null block's volume meets no rates, so it is a row of its own beside the rates of a null block
    assert ("P1", None, "Surface Water") in got and ("P1", "A", "Surface Water") in got
    assert len([r for r in out.collect() if r.RecordNumber == "P2" and r.AllocationBlock is None and r.HydroGroup == "Groundwater"]) == 2


def test_seasons_volumes_and_counts_stay_dealt_by_permit(spark, capsys):
    takes, permits, sites, edges = _tables(spark)
    raw = spark.createDataFrame([("P1", "Take Groundwater", "A", 100.0, "Yes"), ("P1", "Take Groundwater", "In Waitaki", 70.0, "Yes")],
                                "RecordNumber string, take_type string, allo_block string, FullAnnualVolume double, IncludeInGwAllocation string")
    rows = v2.filled_rows(takes, permits, sites, edges)
    arv = v1.allocated_rate_volume(v2.season_means(rows), v2.clean_allocated_volume(raw))
    for df in (arv, v1.site_months(rows), legacy.legacy_split(rows)):
        assert all(d in ("RecordNumber", "WAP") for d in _deals(df, capsys))
    assert sum(r.AllocatedAnnualVolume for r in arv.collect()) == 100  # the exact label wins, and is shared over both take rows
    assert {(r.RecordNumber, r.WAP): r.wap_count for r in v1.site_months(rows).collect() if r.take_type == "Take Groundwater"}["P1", "LA01/0002"] == 1


def test_variant_deals_its_rows_by_permit_and_by_site(spark, monkeypatch):
    from permitflow.catalog import QUERIES, load_all, q_domain
    load_all()
    written, real = [], q_domain.materialize
    monkeypatch.setattr(q_domain, "materialize", lambda df, name="stage": written.append(name) or real(df, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = QUERIES["variant_allocation"](spark, "/root/testdata/sf0.001")
        plan = re.sub(r"#\d+", "", out._jdf.queryExecution().executedPlan().toString())
        assert not [k for k in re.findall(DEALT, plan) if "HydroGroup" in k or "AllocationBlock, Wap" in k]
        assert "variant-inputs" not in written
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_variant_takes_the_first_depletion_and_every_zone_of_a_site(spark):
    inputs = spark.createDataFrame([("P1", "Take Groundwater", "A", "S1", 10.0, 864, 129600, 1, 12, True, True, 1000.0)], "RecordNumber string, TakeType string, AllocationBlock string, Wap string, "
                                   "AllocatedRate double, VolumeDaily long, Volume150Day long, FromMonth int, ToMonth int, IncludeInSwAllocation boolean, IncludeInGwAllocation boolean, FullAnnualVolume double")
    permits = spark.sql("SELECT 'P1' AS RecordNumber, 'Issued - Active' AS ConsentStatus, DATE'2020-01-01' AS FromDate, DATE'2030-01-01' AS ToDate")
    waps = spark.createDataFrame([("S1", 0, 10, False, "Z2", None, False), ("S1", 0, 50, False, "Z1", None, True)],
                                 "Wap string, SD1_7Day int, SD1_150Day int, Storativity boolean, GwSpatialUnitId string, SwSpatialUnitId string, Combined boolean")
    got = sorted((r.HydroGroup, r.SpatialUnitId, r.Combined, r.AllocatedRate, r.AllocatedAnnualVolume) for r in v2.variant_allocation(inputs, permits, waps).collect())
    assert got == [("Groundwater", "Z1", True, 10, 1000), ("Groundwater", "Z2", False, 10, 1000)]  # low: all of it is groundwater


def test_uses_meet_sites_by_permit_and_their_pairs_stay_there(spark, capsys):
    use = spark.createDataFrame([("P1", "Use Groundwater", "x", "5", 9.0), ("P1", "Use Groundwater", "y", "3", None), ("P1", "Use Surface Water", "x", "4", 8.0), (None, "Use Groundwater", "x", "1", 1.0)],
                                "RecordNumber string, UseType string, WaterUse string, IrrigationArea string, ConsentedRate double")
    months = spark.createDataFrame([("P1", "Take Groundwater", "S1", 2), ("P1", "Take Groundwater", "S2", 2), ("P1", None, "S1", None), ("P2", "Take Groundwater", "S1", 1), (None, "Take Groundwater", "S1", None)],
                                   "RecordNumber string, take_type string, WAP string, wap_count long")
    permits, sites = spark.createDataFrame([("P1",)], "RecordNumber string"), spark.createDataFrame([("S1",), ("S2",)], "ExtSiteID string")
    out = v1.water_use(use, months, permits, sites, {"low": ["x"], "high": ["y"]}, ["high", "low"])
    assert set(_deals(out, capsys)) <= {"RecordNumber", "WAP", "ExtSiteID"}
    got = sorted(tuple(r[c] for c in ("RecordNumber", "UseType", "WAP", "WaterUse", "IrrigationArea", "ConsentedRate")) for r in out.collect())
    assert got == [("P1", "Use Groundwater", "S1", "high", "3", None), ("P1", "Use Groundwater", "S2", "high", "3", None)]


def test_walk_writes_a_row_a_permit(spark, monkeypatch):
    from permitflow.operators import hierarchy
    rows = spark.createDataFrame([("P1", None), ("P1", "S3"), ("P1", "S4"), ("P2", "S2"), ("P2", "S1"), ("X", "S0"), ("P3", None)], "RecordNumber string, WAP string")
    edges = spark.createDataFrame([("P1", "P2"), ("P3", "X")], "ParentRecordNumber string, ChildRecordNumber string")
    written, real = {}, hierarchy.materialize

    def seen(df, name="stage"):
        written[name] = real(df, name)
        return written[name]
    monkeypatch.setattr(hierarchy, "materialize", seen)
    nodes = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "RecordNumber string")
    got = nearest_relative_value(rows, edges, nodes=nodes).collect()
    assert [(r.RecordNumber, r.WAP) for r in got] == [("P1", "S1")]  # X is no node
    assert written["walk-keys"].count() == 3


def test_spark_forms_give_the_rows_of_their_templates(spark):
    keys = [(1, 5, 3), (1, 5, 3), (2, 12345, 99), (3, None, 7), (4, None, 17), (5, 30, None), (6, -195, 4), (6, -198, 4), (7, 5, -3), (None, 8, 8), (9, 100, 5)]
    lines = spark.createDataFrame([(o, p, s, n % 2 + 1, 2.0 + n % 3, "N" if n % 2 else "A") for n, (o, p, s) in enumerate(keys)],
                                  "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string")
    lines = lines.unionByName(lines.limit(3))
    orders = spark.createDataFrame([(1,), (1,), (2,), (3,), (6,), (9,), (None,)], "o_orderkey long")
    t = Tables(spark, "/none", {("base", "lineitem"): lines, ("base", "orders"): orders})
    for name in ("b_site", "b_trigger"):
        want = spark.sql(_SQL[name], lineitem=lines, **({"orders": orders} if name == "b_trigger" else {}))
        got = t[name]
        assert got.schema.simpleString() == want.schema.simpleString()
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_interval_join_meets_the_spans_once(spark, tables, capsys):
    from permitflow.catalog.q_domain import join_interval
    assert _plan(join_interval(tables), capsys).count("FromDate#") and "RestrDate" in join_interval(tables).columns
    plan = _plan(join_interval(tables).select(F.lit(1)), capsys)
    assert plan.count("Join") <= 3  # days x bands, bands x spans, bands x orders
