"""Hand tables for rules that the generated fixtures do not reach."""

from pyspark.sql import functions as F

from permitflow.operators.clean import keep_included
from permitflow.operators.quality import check_constraints
from permitflow.operators.spatial import nearest_vertex, points_in_zones
from permitflow.operators.sync import assign_ids, error_log_row, upsert_diff


def test_upsert_keeps_target_only_columns(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, extra string")
    new = spark.createDataFrame([(1, "c"), (3, "d")], "k int, v string")
    merged, changed, _ = upsert_diff(target, new, "k", "2024-01-01")
    assert {(r.k, r.v, r.extra) for r in merged.collect()} == {(1, "c", "x"), (2, "b", "y"), (3, "d", None)}
    assert changed.count() == 2


def test_composite_foreign_key_with_a_null_part(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "b"), (3, None, None)], "k int, x string, y string")
    parent = spark.createDataFrame([("z", "z")], "x string, y string")
    found = check_constraints(df, ["k"], [(["x", "y"], parent, ["x", "y"])]).filter("rule like 'fk%'").collect()
    assert [r.k for r in found] == ["2"]


def test_missing_flag_counts_as_included(spark):
    df = spark.createDataFrame([("Surface Water", None), ("Surface Water", False), ("Groundwater", True)], "g string, f boolean")
    assert keep_included(df, "g", "f", None).count() == 2


def test_null_natural_keys_get_one_id(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, None), ("b", "c")], "x string, y string")
    ids = {(r.x, r.y): r.id for r in assign_ids(df, ["x", "y"]).collect()}
    assert sorted(ids.values()) == [1, 2, 3]


def test_whole_error_text(spark):
    assert error_log_row(spark, "2024-01-01", "t", ValueError("e" * 1000)).select(F.length("Comment")).first()[0] == 1000


def test_points_in_parts_and_holes(spark):
    def square(zone, ring, x, y, size):
        corners = [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
        return [(zone, ring, 10 * i, float(a), float(b)) for i, (a, b) in enumerate(corners)]  # seq with gaps
    rows = square("a", 1, 0, 0, 30000) + square("a", 2, 10000, 10000, 10000) + square("a", 3, 50000, 0, 5000) + square("b", 1, 12000, 12000, 2000)
    vertices = spark.createDataFrame(rows, "zone_id string, ring int, seq int, x double, y double")
    points = spark.createDataFrame([(1, 5000.0, 5000.0), (2, 15000.0, 15000.0), (3, 52000.0, 100.0), (4, 13000.0, 13000.0), (5, 40000.0, 1.0), (6, None, 1.0)],
                                   "id int, px double, py double")
    found = {(r.id, r.zone_id) for r in points_in_zones(points, vertices, "id", "px", "py").collect()}
    assert found == {(1, "a"), (3, "a"), (4, "b")}


def test_nearest_vertex_without_coordinates_or_vertices(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0), (3, float("nan"), 1.0), (4, 9e7, 9e7)], "id int, px double, py double")
    vertices = spark.createDataFrame([(7, "r", 3.0, 4.0), (8, "s", None, 0.0)], "vertex_id int, reach_id string, x double, y double")
    found = {r.id: (r.vertex_id, r.distance) for r in nearest_vertex(points, vertices, "id", "px", "py").collect()}
    assert found[1] == (7, 5.0) and found[2] == found[3] == (None, None) and found[4][0] == 7
    assert nearest_vertex(points, vertices.limit(0), "id", "px", "py").filter("vertex_id IS NULL").count() == 4
