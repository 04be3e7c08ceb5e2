"""Kept dimensions (D1, D2), tables by name (S5) and day-partitioned loads."""

import datetime


def test_a_second_run_adds_nothing_and_changes_no_id(spark, tables, tmp_path):
    from permitflow.operators.kept import versions
    from permitflow.plans import v1
    blocks = v1.seen_blocks(tables["b_wap_allo"], tables["b_allocated_volume"])
    runs = [v1.base_dimensions(spark, str(tmp_path), b, attributes=a) for b, a in (
        (blocks.filter("AllocationBlock = 'B'"), ["WaterUse"]), (blocks, ["IrrigationArea", "WaterUse"]), (blocks, ["IrrigationArea", "WaterUse"]))]
    rows = [{n: {tuple(r) for r in d.collect()} for n, d in run.items()} for run in runs]
    assert rows[1] == rows[2] and rows[0]["AlloBlock"] < rows[1]["AlloBlock"]
    assert rows[0]["Attributes"] == {("WaterUse", 1)} and rows[1]["Attributes"] == {("WaterUse", 1), ("IrrigationArea", 2)}
    assert {n: len(versions(spark, f"{tmp_path}/{n}")) for n in rows[0]} == {"HydroGroup": 1, "Activity": 1, "AlloBlock": 2, "Attributes": 2}
    for table in rows[1].values():
        assert sorted(r[-1] for r in table) == list(range(1, len(table) + 1))


def test_sites_keep_their_ids(spark, tables, tmp_path):
    from permitflow.plans import v1
    from permitflow.plans.common import clean_sites
    register = clean_sites(tables["b_site"])
    ids = lambda df: {r.ExtSiteID: r.SiteID for r in df.collect()}
    args = (tables["b_wap_allo"], tables["b_divert"])
    first = ids(v1.keep_sites(spark, f"{tmp_path}/s", *args, register.filter("SD1_7Day < 30")))
    second = ids(v1.keep_sites(spark, f"{tmp_path}/s", *args, register))
    assert 0 < len(first) < len(second) and first.items() <= second.items() and sorted(second.values()) == list(range(1, len(second) + 1))
    assert ids(v1.keep_sites(spark, f"{tmp_path}/s", *args, register)) == second


def test_only_new_days_are_read_and_written(spark, tmp_path):
    from permitflow.plans.timeseries import slice_range
    from permitflow.sources.tables import load_new_days
    log = spark.sql("SELECT id, date_add(DATE '2024-01-01', CAST(id % 20 AS INT)) AS day FROM range(400)")
    log.write.partitionBy("day").parquet(f"{tmp_path}/log")
    feed = spark.read.schema(log.schema).parquet(f"{tmp_path}/log")
    assert load_new_days(feed, f"{tmp_path}/t", "day", "2024-01-08", "2024-01-03") == ("2024-01-03", "2024-01-08")
    before = set(spark.read.parquet(f"{tmp_path}/t").inputFiles())
    assert load_new_days(feed, f"{tmp_path}/t", "day", "2024-01-10") == ("2024-01-09", "2024-01-10")
    after = set(spark.read.parquet(f"{tmp_path}/t").inputFiles())
    assert before < after and all("day=2024-01-09" in f or "day=2024-01-10" in f for f in after - before)
    assert load_new_days(feed, f"{tmp_path}/t", "day", "2024-01-10") is None
    found = spark.read.parquet(f"{tmp_path}/t")
    assert found.count() == 160 and found.agg({"day": "min"}).first()[0] == datetime.date(2024, 1, 3)
    plan = slice_range(feed, "day", ("2024-01-09", "2024-01-10"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_table_by_name(spark, tmp_path):
    from permitflow.sources.tables import catalog_table, read_table
    df = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-02-01"), (3, "a", "2024-03-01")], "id int, `kind of` string, day string")
    name = catalog_table(df, "pf_test", "things", str(tmp_path))
    assert name == "pf_test.things" and spark.table(name).count() == 3
    got = read_table(spark, name, cols=["id", "kind of"], rename={"kind of": "kind"}, where_in={"kind of": ["a"]}, from_date="2024-02-01", date_col="day")
    assert [tuple(r) for r in got.collect()] == [(3, "a")] and got.columns == ["id", "kind"]
    spark.sql("DROP TABLE pf_test.things")
