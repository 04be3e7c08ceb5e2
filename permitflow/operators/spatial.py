"""Spatial operators (G1, G2) as grid joins on plain coordinate columns.

No geometry type and no per-row geometry library: polygons are vertex rows,
points are (x, y) columns. Both operators first reduce candidates with an
equi-join on grid cells, so no point is compared with every polygon or vertex.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..session import ensure_checkpoint_dir, materialize, materialize_counted

log = logging.getLogger(__name__)


def polygon_edges(vertices: DataFrame, zone: str = "zone_id", seq: str = "seq", x: str = "x", y: str = "y",
                  ring: str = "ring") -> DataFrame:
    """Ring edges (x1, y1) -> (x2, y2) from ordered vertex rows; a ring's last
    vertex closes to its first. A zone may have several rings (parts and holes),
    told apart by ``ring`` where that column exists; ``seq`` may have gaps. The
    window holds one ring's vertices."""
    own = Window.partitionBy(zone, *([ring] if ring in vertices.columns else [])).orderBy(seq)
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = vertices.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return v.select(F.col(zone), F.col(x).alias("x1"), F.col(y).alias("y1"),
                    F.coalesce(F.lead(x).over(own), F.first(x).over(whole)).alias("x2"),
                    F.coalesce(F.lead(y).over(own), F.first(y).over(whole)).alias("y2"))


def points_in_zones(points: DataFrame, vertices: DataFrame, point_key: str, px: str, py: str,
                    zone: str = "zone_id", cell: float = 5000.0, how: str = "inner") -> DataFrame:
    """G1: (point_key, zone) for points inside a zone polygon; one zone per
    point (the smallest id when zones overlap).

    1. zone bounding boxes are exploded into the grid cells they cover and
       equi-joined with the points' cells -> candidate (point, zone) pairs;
    2. ray casting against the candidate zones' edges of the point's own y band
       (an equi-join on zone and band): a point is inside when an odd number of
       edges cross the horizontal ray to its right, over all rings of the zone,
       so holes are outside and every part counts.
    """
    edges = polygon_edges(vertices, zone)
    bbox = edges.groupBy(zone).agg(F.least(F.min("x1"), F.min("x2")).alias("minx"), F.greatest(F.max("x1"), F.max("x2")).alias("maxx"),
                                   F.least(F.min("y1"), F.min("y2")).alias("miny"), F.greatest(F.max("y1"), F.max("y2")).alias("maxy"))
    cells = bbox.select(zone, "minx", "maxx", "miny", "maxy",
                        F.explode(F.sequence(F.floor(F.col("minx") / cell), F.floor(F.col("maxx") / cell))).alias("cx")) \
                .withColumn("cy", F.explode(F.sequence(F.floor(F.col("miny") / cell), F.floor(F.col("maxy") / cell))))
    pts = points.select(F.col(point_key).alias("_pk"), F.col(px).cast("double").alias("_px"), F.col(py).cast("double").alias("_py")) \
                .withColumn("cx", F.floor(F.col("_px") / cell)).withColumn("cy", F.floor(F.col("_py") / cell))
    cand = pts.join(cells, ["cx", "cy"]).filter(F.col("_px").between(F.col("minx"), F.col("maxx"))
                                                & F.col("_py").between(F.col("miny"), F.col("maxy"))) \
              .select("_pk", "_px", "_py", zone, "cy")
    banded = edges.withColumn("cy", F.explode(F.sequence(F.floor(F.least("y1", "y2") / cell), F.floor(F.greatest("y1", "y2") / cell))))
    e = cand.join(banded, [zone, "cy"])
    crosses = (F.col("y1") > F.col("_py")) != (F.col("y2") > F.col("_py"))
    xint = F.col("x1") + F.try_divide((F.col("_py") - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1"))
    hit = F.when(crosses & (F.col("_px") < xint), 1).otherwise(0)
    inside = e.groupBy("_pk", zone).agg(F.sum(hit).alias("_n")).filter(F.col("_n") % 2 == 1)
    one = inside.groupBy("_pk").agg(F.min(zone).alias(zone))
    out = points.join(one.withColumnRenamed("_pk", point_key), point_key, how)
    return out


_IN_CELL = 16  # vertices that a cell of the finest level may hold, unless they lie closer than the smallest cell
_HALVINGS = 20


def _dealt(verts: DataFrame, cell: float) -> DataFrame:
    return verts.withColumns({"cx": F.floor(F.col("_vx") / cell), "cy": F.floor(F.col("_vy") / cell)})


def _fine_cell(verts: DataFrame, cell: float) -> float:
    """This cell size, or a half, a quarter ... of it, so that no cell holds many vertices."""
    for _ in range(_HALVINGS):
        most = _dealt(verts, cell).groupBy("cx", "cy").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if most <= _IN_CELL:
            break
        cell /= 2
    return cell


def _cell_levels(verts: DataFrame) -> list[DataFrame]:
    """Non-empty cells of the vertices with the bounding boxes of what they hold; each level's cells are four of the
    level before. At the last level there are four cells at most."""
    box = [F.min("x1").alias("x1"), F.max("x2").alias("x2"), F.min("y1").alias("y1"), F.max("y2").alias("y2")]
    first = verts.select(F.col("_vx").alias("x1"), F.col("_vx").alias("x2"), F.col("_vy").alias("y1"), F.col("_vy").alias("y2"), "cx", "cy")
    levels = [materialize(first.groupBy("cx", "cy").agg(*box), "nearest-cells0")]
    span = levels[0].agg((F.max("cx") - F.min("cx")).alias("x"), (F.max("cy") - F.min("cy")).alias("y")).first()
    while max(span) >= 2 ** (len(levels) - 1):
        up = levels[-1].select("x1", "x2", "y1", "y2", F.floor(F.col("cx") / 2).alias("cx"), F.floor(F.col("cy") / 2).alias("cy"))
        levels.append(materialize(up.groupBy("cx", "cy").agg(*box), f"nearest-cells{len(levels)}"))
    return levels


def _candidates(boxes: DataFrame, verts: DataFrame) -> DataFrame:
    """(ux, uy, near) for boxes of points (ux, uy, px1, px2, py1, py2): the vertices (_vx, _vy, _vk, _g) that may be the
    nearest one of a point in the box. From the coarsest cells down, a box goes on with those cells that may hold a
    vertex as near as the one that some cell must hold for all of its points."""
    levels = _cell_levels(verts)
    top = levels[-1].collect()  # four cells at most
    cells = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("cx", "cy", "x1", "x2", "y1", "y2")]) for r in top])
    box = ["ux", "uy", "px1", "px2", "py1", "py2"]
    size = lambda dx, dy: F.sqrt(dx * dx + dy * dy)
    out = lambda p, a: F.greatest(F.col(f"{a}1") - F.col(f"{p}2"), F.col(f"{p}1") - F.col(f"{a}2"), F.lit(0.0))
    end = lambda p, a: F.greatest(F.col(f"{a}2") - F.col(f"{p}1"), F.col(f"{p}2") - F.col(f"{a}1"))

    def nearest(met: DataFrame, *what: str) -> DataFrame:
        """Of each box the rows that may hold its nearest vertices, as structs ``c`` of these columns."""
        met = met.withColumns({"lo": size(out("px", "x"), out("py", "y")), "hi": size(end("px", "x"), end("py", "y"))})
        near = met.groupBy(*box).agg(F.min("hi").alias("sure"), F.collect_list(F.struct("lo", *what)).alias("c"))
        return near.select(*box, F.filter("c", lambda c: c["lo"] <= F.col("sure")).alias("c"))

    now = boxes.repartition("ux", "uy").withColumn("c", F.explode(cells)).select(*box, "c.*")
    seen = []
    for k in range(len(levels) - 1, -1, -1):
        seen.append((k, Observation()))
        now = nearest(now.observe(seen[-1][1], F.count("*").alias("n")), "cx", "cy").withColumn("c", F.explode("c")).select(*box, "c.cx", "c.cy")
        if k:
            below = levels[k - 1].select(F.floor(F.col("cx") / 2).alias("wx"), F.floor(F.col("cy") / 2).alias("wy"), "cx", "cy", "x1", "x2", "y1", "y2")
            now = now.withColumnsRenamed({"cx": "wx", "cy": "wy"}).join(below, ["wx", "wy"])
    last = verts.select("*", *[F.col(f"_v{c}").alias(f"{c}{i}") for c in "xy" for i in (1, 2)])
    found = materialize(nearest(now.join(last, ["cx", "cy"]), "_vx", "_vy", "_vk", "_g").select("ux", "uy", F.col("c").alias("near")), "nearest-candidates")
    for k, n in seen:
        log.info("nearest level %d: %d cells of the boxes of points", k, n.get["n"])
    return found


def nearest_vertex(points: DataFrame, vertices: DataFrame, point_key: str, px: str, py: str,
                   vertex_key: str = "vertex_id", group: str = "reach_id", vx: str = "x", vy: str = "y",
                   cell: float = 1000.0) -> DataFrame:
    """Nearest vertex (ties: smallest id) and its distance for every point.

    Points are dealt into cells, and each cell's box goes down a hierarchy of the vertices' non-empty cells
    (``_candidates``), all by equi-joins on cell ids; a point then compares the vertices found for its box, in its own row.
    Of vertices at one place only the first can be a result, and cells are at most ``cell`` wide and so fine that each holds
    few vertices, so a point meets few of them however many there are. Points without finite coordinates get
    nulls, vertices without them are left out, and without vertices all points get nulls.
    """
    ensure_checkpoint_dir(points.sparkSession)

    def finite(c: str) -> Column:
        return F.abs(F.col(c)) < F.lit(float("inf"))  # false for NaN, null for null
    pts = points.select(F.col(point_key).alias("_pk"), F.col(px).cast("double").alias("_px"), F.col(py).cast("double").alias("_py"))
    pts = pts.filter(finite("_px") & finite("_py"))
    verts = vertices.select(F.col(vertex_key).alias("_vk"), F.col(group).alias("_g"),
                            F.col(vx).cast("double").alias("_vx"), F.col(vy).cast("double").alias("_vy")).filter(finite("_vx") & finite("_vy"))
    verts = verts.groupBy("_vx", "_vy").agg(F.min(F.struct("_vk", "_g")).alias("v")).select("_vx", "_vy", "v.*")
    verts, n = materialize_counted(verts, "nearest-vertices", n=F.count("*"))
    none = [F.lit(None).cast(t).alias(c) for c, t in ((vertex_key, vertices.schema[vertex_key].dataType), (group, vertices.schema[group].dataType), ("distance", "double"))]
    if not n["n"]:
        return points.select("*", *none)
    cell = _fine_cell(verts, cell)
    pts = pts.withColumns({"ux": F.floor(F.col("_px") / cell), "uy": F.floor(F.col("_py") / cell)})
    boxes = pts.groupBy("ux", "uy").agg(F.min("_px").alias("px1"), F.max("_px").alias("px2"), F.min("_py").alias("py1"), F.max("_py").alias("py2"))
    near = _candidates(materialize(boxes, "nearest-boxes"), materialize(_dealt(verts, cell), "nearest-dealt"))

    def measured(v: Column) -> Column:
        dx, dy = F.col("_px") - v["_vx"], F.col("_py") - v["_vy"]
        return F.struct(F.sqrt(dx * dx + dy * dy).alias("d"), v["_vk"].alias("_vk"), v["_g"].alias("_g"))
    res = pts.join(near, ["ux", "uy"]).select("_pk", F.array_min(F.transform("near", measured)).alias("b"))
    res = res.groupBy("_pk").agg(F.min("b").alias("b")).select("_pk", F.col("b.d").alias("_d"), F.col("b._vk").alias("_vk"), F.col("b._g").alias("_g"))
    res = res.select(F.col("_pk").alias(point_key), F.col("_vk").alias(vertex_key), F.col("_g").alias(group),
                     F.col("_d").alias("distance"))
    return points.join(res, point_key, "left")
