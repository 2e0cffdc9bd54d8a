from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from citygrain.functions import geo
from citygrain.operators import context
from citygrain.operators import spatial as ops
from tests.conftest import values

L_SHAPE = [[(0, 0), (8, 0), (8, 4), (4, 4), (4, 8), (0, 8), (0, 0)]]
HOLE = [[(10, 0), (18, 0), (18, 8), (10, 8), (10, 0)], [(12, 2), (16, 2), (16, 6), (12, 6), (12, 2)]]
TRIANGLE = [[(8, 4), (10, 8), (4, 8), (8, 4)]]
SLANTED = [[(0.3, 9.1), (17.7, 8.9), (9.2, 15.55), (5.1, 11.3), (0.3, 9.1)]]
BOX = [[(0, 0), (20, 0), (20, 16), (0, 16), (0, 0)]]


def zones_df(spark, shapes):
    rows = [
        (i, f"z{i}", [[(float(x), float(y)) for x, y in ring] for ring in rings]) for i, rings in enumerate(shapes)
    ]
    return spark.createDataFrame(rows, f"feature_index bigint, zone string, rings {geo.GEOMETRY}")


def covers(rings, x, y):
    """Even-odd with the boundary, in exact arithmetic."""
    x, y = Fraction(x), Fraction(y)
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            x1, y1, x2, y2 = map(Fraction, (x1, y1, x2, y2))
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def first_zone(shapes, x, y):
    return next((f"z{i}" for i, rings in enumerate(shapes) if covers(rings, x, y)), None)


@pytest.mark.parametrize("options", [{}, {"max_candidates": 0}, {"level": 6}, {"level": -2}, {"level": -2, "max_candidates": 0}])
def test_points_equal_brute_force(spark, options):
    shapes = [L_SHAPE, HOLE, TRIANGLE, SLANTED]
    rng = random.Random(5)
    points = [(x / 2, y / 2) for x in range(-2, 44) for y in range(-2, 36)]
    points += [(rng.uniform(-1, 21), rng.uniform(-1, 17)) for _ in range(500)]
    points += points[:50]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    found = ops.spatial_join(df, zones_df(spark, shapes), {"zone": "zone"}, "x", "y", **options)
    rows = {row["i"]: row["zone"] for row in found.collect()}
    assert found.columns == ["i", "x", "y", "zone"] and len(rows) == len(points)
    for i, (x, y) in enumerate(points):
        assert rows[i] == first_zone(shapes, x, y), (x, y)


def test_shared_edge_goes_to_the_lower_index_and_missing_coordinates_stay(spark):
    left = [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]]
    right = [[(4, 0), (8, 0), (8, 4), (4, 4), (4, 0)]]
    df = spark.createDataFrame([(1, 4.0, 2.0), (2, None, 2.0), (3, 4.0, None), (4, 9.0, 2.0)], "i int, x double, y double")
    for shapes, winner in (([left, right], "z0"), ([right, left], "z0")):
        found = ops.spatial_join(df, zones_df(spark, shapes), {"zone": "z"}, "x", "y")
        assert dict(values(found, "i", "z")) == {1: winner, 2: None, 3: None, 4: None}


def test_no_zone_at_all(spark):
    df = spark.createDataFrame([(1, 4.0, 2.0)], "i int, x double, y double")
    found = ops.spatial_join(df, zones_df(spark, []), {"zone": "z"}, "x", "y")
    assert values(found, "i", "z") == [(1, None)]


def inside_length(rings, p, q):
    """Length of the part of p->q inside, by cutting at every edge in exact arithmetic."""
    px, py, qx, qy = map(Fraction, (*p, *q))
    dx, dy = qx - px, qy - py
    cuts = {Fraction(0), Fraction(1)}
    for ring in rings:
        for a, b in zip(ring, ring[1:]):
            ax, ay, bx, by = map(Fraction, (*a, *b))
            ex, ey = bx - ax, by - ay
            cross = dx * ey - dy * ex
            if cross != 0:
                cuts.add(((ax - px) * ey - (ay - py) * ex) / cross)
            else:
                for x, y in ((ax, ay), (bx, by)):
                    cuts.add(((x - px) * dx + (y - py) * dy) / (dx * dx + dy * dy))
    ordered = sorted(t for t in cuts if 0 <= t <= 1)
    share = sum(
        t - s for s, t in zip(ordered, ordered[1:]) if covers(rings, px + (s + t) / 2 * dx, py + (s + t) / 2 * dy)
    )
    return float(share) * math.hypot(float(dx), float(dy))


@pytest.mark.parametrize("level", [None, 1, 7])
def test_clipped_lengths_equal_brute_force(spark, level):
    shapes = [L_SHAPE, HOLE, TRIANGLE, BOX]
    rng = random.Random(11)
    grid = [(rng.randint(-2, 22), rng.randint(-2, 18)) for _ in range(120)]
    lines = [grid[i : i + 4] for i in range(0, 120, 4)]
    lines += [[(0, 0), (8, 0), (8, 8)], [(12, 2), (16, 2), (16, 6)], [(-5, -5), (-1, -1)]]
    # A segment that reaches far beyond the layer must not be listed cell by cell out there.
    lines += [[(-10**9, 3), (10**9, 3)], [(4, -10**9), (4, 10**9)], [(30, 5), (10**9, 5)]]
    df = spark.createDataFrame(
        [(i, [[(float(x), float(y)) for x, y in line]]) for i, line in enumerate(lines)],
        f"line int, parts {geo.GEOMETRY}",
    )
    found = ops.clip_lines(df, zones_df(spark, shapes), "line", ["zone"], level=level)
    lengths = {(row["line"], row["zone"]): row["length"] for row in found.withColumn("length", geo.length(F.col("parts"))).collect()}
    assert found.select("line", "zone").distinct().count() == len(lengths)
    for i, line in enumerate(lines):
        for z, rings in enumerate(shapes):
            want = sum(inside_length(rings, p, q) for p, q in zip(line, line[1:]) if p != q)
            assert lengths.get((i, f"z{z}"), 0.0) == pytest.approx(want, abs=1e-6), (i, z)


def test_clipped_shape(spark):
    zone = [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]]
    line = [(-2.0, 2.0), (2.0, 2.0), (2.0, 6.0), (3.0, 6.0), (3.0, 3.0), (3.5, 3.5)]
    corner = [(4.0, -1.0), (5.0, 0.0), (4.0, 0.0), (4.0, -1.0)]
    df = spark.createDataFrame([(1, [line]), (2, [corner]), (3, [[(9.0, 9.0), (9.0, 9.0)]])], f"line int, parts {geo.GEOMETRY}")
    found = ops.clip_lines(df, zones_df(spark, [zone]), "line", ["zone"]).collect()
    # A touch in one point leaves no line.
    assert [row["line"] for row in found] == [1]
    parts = [[tuple(p) for p in part] for part in found[0]["parts"]]
    assert parts == [[(0.0, 2.0), (2.0, 2.0), (2.0, 4.0)], [(3.0, 4.0), (3.0, 3.0), (3.5, 3.5)]]


def test_cells_and_environment(spark):
    zones = zones_df(spark, [L_SHAPE, HOLE, [[(50, 50), (60, 50), (60, 60), (50, 50)]]])
    cells = spark.createDataFrame(
        [
            (23, 0.0, 0.0, 2.0, 2.0),
            (11, 2.0, 0.0, 3.0, 1.0),
            (33, 13.0, 3.0, 15.0, 5.0),  # in the hole
            (31, 10.0, 0.0, 11.0, 1.0),
            (31, 5.0, 5.0, 5.0, 9.0),  # no area
            (31, 100.0, 100.0, 101.0, 101.0),  # outside the extent
        ],
        "category int, minx double, miny double, maxx double, maxy double",
    )
    inside = ops.prepare_cells(cells, ops.layer_extent(zones))
    assert inside.count() == 4
    assigned = ops.assign_cells(inside, zones, "zone")
    found = sorted(values(context.environment_metrics(assigned, zones, "zone"), "zone", "noise_score", "air_score", "high_noise_share_pct", "noise_cell_count"))
    assert found == [("z0", 2.6, 1.8, 80.0, 2), ("z1", 1.0, 3.0, 0.0, 1), ("z2", 0.0, 0.0, 0.0, 0)]


def test_small_zone_layer_leaves_the_points_unshuffled(spark):
    points = spark.range(1000).select((F.col("id") % 20).cast("double").alias("x"), F.lit(1.0).alias("y"))
    found = ops.spatial_join(points, zones_df(spark, [L_SHAPE, HOLE]), {"zone": "zone"}, "x", "y")
    assert found.count() == 1000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


@pytest.mark.parametrize("most", [512, 0])
def test_coordinates_that_are_no_numbers_have_no_zone(spark, most):
    nan, inf = float("nan"), float("inf")
    points = [(0, 1.0, 1.0), (1, nan, nan), (2, nan, 0.5), (3, 0.5, inf), (4, -inf, 0.0), (5, None, 0.0)]
    frame = spark.createDataFrame(points, "id int, longitude double, latitude double")
    found = ops.spatial_join(frame, zones_df(spark, [BOX, L_SHAPE]), {"zone": "zone"}, max_candidates=most)
    assert {row["id"]: row["zone"] for row in found.collect()} == {0: "z0", 1: None, 2: None, 3: None, 4: None, 5: None}


def test_copies_of_one_outline_leave_one_candidate(spark, monkeypatch):
    """600 zones with the outline of L_SHAPE, then a box: the first copy is found, and the pile fills no cell."""
    def by_pairs(*args):
        raise AssertionError("a pile of copies took the way by pairs")

    monkeypatch.setattr(ops, "_join_by_pairs", by_pairs)
    zones = zones_df(spark, [L_SHAPE] * 600 + [BOX]).withColumn("feature_index", F.when(F.col("zone") == "z600", 5000).otherwise(1000 - F.col("feature_index")))
    points = spark.createDataFrame([(1.0, 1.0), (6.0, 6.0), (30.0, 30.0)], "x double, y double")
    found = ops.spatial_join(points, zones, {"zone": "zone"}, "x", "y")
    assert sorted(values(found, "x", "zone"), key=str) == sorted([(1.0, "z599"), (6.0, "z600"), (30.0, None)], key=str)


def crossing_lines(spark):
    rng = random.Random(3)
    rows = [(i, [[(rng.uniform(-2, 22), rng.uniform(-2, 18)) for _ in range(5)], [(float(rng.randint(-1, 21)), float(rng.randint(-1, 17))) for _ in range(4)]]) for i in range(60)]
    return spark.createDataFrame(rows, f"line int, parts {geo.GEOMETRY}").withColumn("name", F.concat(F.lit("n"), "line"))


def test_lines_cut_by_one_task_equal_those_cut_by_segments(spark):
    lines, zones = crossing_lines(spark), zones_df(spark, [L_SHAPE, HOLE, TRIANGLE, SLANTED, BOX, BOX])
    whole = ops.clip_lines(lines, zones, "line", ["zone"], carried=["name"])
    spread = ops.clip_lines(lines, zones, "line", ["zone"], carried=["name"], long_line=0)
    names = ("line", "zone", "name", "parts")
    assert whole.columns == spread.columns == ["line", "zone", "parts", "name"]
    assert sorted(values(whole, *names)) == sorted(values(spread, *names)) and whole.count() > 150
    # No span of a line is shuffled or put in order once more.
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "MapInArrow" in plan
    assert "Window" in spread._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_one_id_are_one_line_and_each_gets_its_row(spark):
    lines = crossing_lines(spark).where("line < 6")
    zones = zones_df(spark, [L_SHAPE, BOX])
    shared = lines.unionByName(lines.where("line = 2").withColumn("name", F.lit("again"))).unionByName(lines.where("line = 3").withColumn("line", F.lit(None).cast("int")))
    alone = ops.clip_lines(lines, zones, "line", ["zone"], carried=["name"])
    both = ops.clip_lines(shared, zones, "line", ["zone"], carried=["name"])
    again = alone.where("line = 2").withColumn("name", F.lit("again"))
    names = ("line", "zone", "name", "parts")
    assert sorted(values(both, *names)) == sorted(values(alone.unionByName(again), *names))
    # Without carried columns a shared id has one row for each zone, and so has no id at all.
    found = values(ops.clip_lines(shared, zones, "line", ["zone"]), "line", "zone")
    assert len(found) == len(set(found)) and any(line is None for line, _ in found)


def test_lines_without_points_or_numbers_have_no_part(spark):
    lines = [(1, None), (2, []), (3, [None, [(1.0, 1.0)]]), (4, [[(1.0, 1.0), (None, 2.0), (3.0, 3.0), (3.0, 5.0)]])]
    df = spark.createDataFrame(lines, f"line int, parts {geo.GEOMETRY}")
    found = ops.clip_lines(df, zones_df(spark, [BOX]), "line", ["zone"])
    assert [(row["line"], [[tuple(p) for p in part] for part in row["parts"]]) for row in found.collect()] == [(4, [[(3.0, 3.0), (3.0, 5.0)]])]


def test_points_meet_their_zones_in_whole_batches(spark):
    """A zone without an order is found by a point that no other zone covers; by pairs it is never the first."""
    zones = zones_df(spark, [TRIANGLE, BOX]).withColumn("feature_index", F.when(F.col("zone") == "z0", 7))
    points = spark.createDataFrame([(19.0, 15.0), (30.0, 0.0)], "x double, y double")
    found = ops.spatial_join(points, zones, {"zone": "zone"}, "x", "y")
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    assert dict(values(found, "x", "zone")) == {19.0: "z1", 30.0: None}


def test_sides_that_are_worked_out_are_worked_out_once(spark):
    cells = spark.range(50).select((F.col("id") % 3 * 10 + 1).cast("int").alias("category"), F.sinh(F.col("id") / 10).alias("minx"), F.col("id").cast("double").alias("miny"))
    cells = cells.withColumns({"maxx": F.col("minx") + F.col("miny") % 4, "maxy": F.col("miny") + 1})
    extent = (1.0, 2.0, 30.0, 40.0)
    once, typed = ops.prepare_cells(cells, extent, parsed=True), ops.prepare_cells(cells, extent)
    assert sorted(values(once, *once.columns)) == sorted(values(typed, *typed.columns)) and once.columns == typed.columns
    assert once._jdf.queryExecution().optimizedPlan().toString().count("SINH(") == 1
