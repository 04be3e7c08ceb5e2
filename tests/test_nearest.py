"""G2 against all pairs, near and far."""

import logging
import math
import random
import re

import pytest


def run(spark, points, vertices, cell=1000.0):
    from permitflow.operators.spatial import nearest_vertex
    p = spark.createDataFrame(points, "id int, px double, py double")
    v = spark.createDataFrame(vertices, "vertex_id int, reach_id string, x double, y double")
    return {r.id: (r.vertex_id, r.distance) for r in nearest_vertex(p, v, "id", "px", "py", cell=cell).collect()}


def brute(points, vertices):
    ok = lambda *xs: all(x is not None and math.isfinite(x) for x in xs)
    out = {}
    for i, x, y in points:
        near = [(math.sqrt((x - vx) * (x - vx) + (y - vy) * (y - vy)), k) for k, _, vx, vy in vertices if ok(vx, vy)] if ok(x, y) else []
        out[i] = min(near)[::-1] if near else (None, None)
    return out


@pytest.mark.parametrize("seed, spread", [(1, 3e3), (2, 1e5), (3, 2e6)])
def test_random_points(spark, seed, spread):
    rng = random.Random(seed)
    at = lambda: round(rng.uniform(-spread, spread) / 500) * 500.0  # noqa: E731  many ties
    vertices = [(k, f"R{k % 7}", at(), at()) for k in range(150)] + [(900, "R", None, 1.0), (901, "R", float("nan"), 1.0)]
    points = [(i, at() * rng.choice([1, 1, 5]), at()) for i in range(80)] + [(500, 1e9, -1e9), (501, None, 0.0), (502, float("inf"), 0.0)]
    assert run(spark, points, vertices) == brute(points, vertices)


def test_a_far_point_meets_few_cells_and_vertices(spark, caplog):
    rng = random.Random(4)
    vertices = [(k, "R", rng.uniform(0, 1e5), rng.uniform(0, 4e4)) for k in range(4000)]
    points = [(1, 1e7, 2e4), (2, -3e6, -1e7)]
    with caplog.at_level(logging.INFO, logger="permitflow.operators.spatial"):
        assert run(spark, points, vertices) == brute(points, vertices)
    cells = [int(m.group(1)) for m in re.finditer(r"nearest level \d+: (\d+) cells", caplog.text)]
    assert len(cells) == 8 and max(cells) <= 2 * 40


def test_no_vertices_and_one_vertex(spark):
    assert run(spark, [(1, 0.0, 0.0)], [(1, "R", None, None)]) == {1: (None, None)}
    assert run(spark, [(1, 0.0, 0.0), (2, 5e8, 0.0)], [(7, "R", 3.0, 4.0)]) == {1: (7, 5.0), 2: (7, math.sqrt((5e8 - 3) ** 2 + 16))}


def test_vertices_at_one_place_and_dense_ones_are_not_all_met(spark, caplog):
    """Before, each point near them met all vertices of a place, and all of a cell."""
    from permitflow.operators import spatial
    vertices = [(k, f"R{k % 3}", 10.0, 20.0) for k in range(500, 0, -1)]
    dense = [(1000 + k, "D", 5e4 + k % 40 * 10.0, 5e4 + k // 40 * 10.0) for k in range(1600)]
    points = [(1, 11.0, 21.0), (2, -500.0, 0.0), (3, 5.0013e4, 5.0101e4), (4, 5.0201e4, 5.0377e4), (5, 3e4, 3e4)]
    assert run(spark, points, vertices + dense) == brute(points, vertices + dense)
    with caplog.at_level(logging.INFO, logger="permitflow.operators.spatial"):
        assert run(spark, points, vertices + dense) == brute(points, vertices + dense)
    cells = [int(m.group(1)) for m in re.finditer(r"nearest level \d+: (\d+) cells", caplog.text)]
    assert max(cells) <= 5 * 40 and spatial._IN_CELL < 40
