"""Spatial joins: zones come from nation and supplier, points and lines from lineitem and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.functions import geo
from citygrain.functions.numbers import round_even
from citygrain.operators import spatial as ops
from workloads.registry import register, round_sql, table

c = F.col


def _at(x: Column, y: Column, *corners: tuple[float, float]) -> Column:
    return geo.ring(*[(x + dx, y + dy) for dx, dy in corners])


def nation_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 5 x 5 map of nations, 12 wide and 4 high: triangles, L-shapes, squares with a hole, boxes.

    Quarters of a unit only, so that every test is exact.
    """
    key = c("n_nationkey")
    x, y = (key % 5) * 12.0, F.floor(key / 5) * 4.0
    box = _at(x, y, (0, 0), (12, 0), (12, 4), (0, 4))
    triangle = _at(x, y, (0, 0), (12, 0), (12, 4))
    angle = _at(x, y, (0, 0), (12, 0), (12, 2), (6, 2), (6, 4), (0, 4))
    hole = _at(x, y, (3, 1), (9, 1), (9, 3), (3, 3))
    rings = (
        F.when(key % 4 == 0, F.array(box))
        .when(key % 4 == 1, F.array(triangle))
        .when(key % 4 == 2, F.array(angle))
        .otherwise(F.array(box, hole))
    )
    return table(spark, sf_dir, "nation").select(
        key.cast("bigint").alias("feature_index"), key.alias("zone"), c("n_name").alias("zone_name"), rings.alias("rings")
    )


# One zone holds a point if its box does and its shape does. Boundaries belong to the zone.
ZONE_HIT_SQL = """
  px BETWEEN zx AND zx + 12 AND py BETWEEN zy AND zy + 4 AND
  CASE n_nationkey % 4
    WHEN 0 THEN true
    WHEN 1 THEN (py - zy) * 3 <= (px - zx)
    WHEN 2 THEN px - zx <= 6 OR py - zy <= 2
    ELSE px - zx <= 3 OR px - zx >= 9 OR py - zy <= 1 OR py - zy >= 3 END
"""
ZONES_SQL = """zones AS (SELECT n_nationkey, n_name, (n_nationkey % 5) * 12.0::DOUBLE AS zx,
    (n_nationkey // 5) * 4.0::DOUBLE AS zy FROM nation)"""
# Quarter steps around the map and beyond, often exactly on an edge; some points lack a coordinate.
POINTS_SQL = """points AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE (l_orderkey % 260) / 4.0::DOUBLE - 2 END AS px,
    CASE WHEN l_suppkey % 50 = 3 THEN NULL ELSE (l_partkey % 92) / 4.0::DOUBLE - 1 END AS py FROM lineitem)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        F.when(c("l_linenumber") != 7, (c("l_orderkey") % 260) / 4.0 - 2).alias("px"),
        F.when(c("l_suppkey") % 50 != 3, (c("l_partkey") % 92) / 4.0 - 1).alias("py"),
    )


JOIN_SQL = f"""WITH {ZONES_SQL}, {POINTS_SQL},
    places AS (SELECT DISTINCT px, py FROM points WHERE px IS NOT NULL AND py IS NOT NULL),
    hits AS (SELECT px, py, min(n_nationkey) AS zone, arg_min(n_name, n_nationkey) AS zone_name
      FROM places JOIN zones ON {ZONE_HIT_SQL} GROUP BY px, py)
    SELECT points.*, zone, zone_name FROM points LEFT JOIN hits USING (px, py)"""
PROPERTIES = {"zone": "zone", "zone_name": "zone_name"}


@register(JOIN_SQL)
def points_in_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.spatial_join(points(spark, sf_dir), nation_zones(spark, sf_dir), PROPERTIES, "px", "py")


@register(JOIN_SQL)
def points_in_piled_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken where many zones meet in one cell."""
    return ops.spatial_join(
        points(spark, sf_dir), nation_zones(spark, sf_dir), PROPERTIES, "px", "py", max_candidates=1
    )


@register(
    f"""WITH {ZONES_SQL}, {POINTS_SQL},
    places AS (SELECT px, py, count(*) AS n FROM points WHERE px IS NOT NULL AND py IS NOT NULL GROUP BY px, py),
    boxes AS (SELECT s_suppkey, (s_suppkey * 7 % 240) / 4.0::DOUBLE AS bx, (s_suppkey * 5 % 72) / 4.0::DOUBLE AS b_y
      FROM supplier),
    hits AS (SELECT px, py, min(s_suppkey) AS block FROM places
      JOIN boxes ON px BETWEEN bx AND bx + 2.5 AND py BETWEEN b_y AND b_y + 1.25 GROUP BY px, py)
    SELECT points.*, block FROM points LEFT JOIN hits USING (px, py)"""
)
def points_in_overlapping_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of suppliers overlap; the one with the lowest index wins."""
    x, y = (c("s_suppkey") * 7 % 240) / 4.0, (c("s_suppkey") * 5 % 72) / 4.0
    blocks = table(spark, sf_dir, "supplier").select(
        c("s_suppkey").alias("feature_index"),
        c("s_suppkey").alias("block"),
        F.array(_at(x, y, (0, 0), (2.5, 0), (2.5, 1.25), (0, 1.25))).alias("rings"),
    )
    return ops.spatial_join(points(spark, sf_dir), blocks, {"block": "block"}, "px", "py")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a street of two segments."""
    key, customer = c("o_orderkey"), c("o_custkey")
    a = geo.point((key % 240) / 4.0 + 0.125, (customer % 80) / 4.0 + 0.125)
    b = geo.point((customer % 232) / 4.0 + 0.125, (key % 72) / 4.0 + 0.125)
    d = geo.point((key * 7 % 240) / 4.0 + 0.125, (customer * 3 % 80) / 4.0 + 0.125)
    return table(spark, sf_dir, "orders").select(key.alias("street"), F.array(F.array(a, b, d)).alias("parts"))


def box_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = c("n_nationkey")
    x, y = (key % 5) * 12.0, F.floor(key / 5) * 4.0
    return table(spark, sf_dir, "nation").select(
        key.cast("bigint").alias("feature_index"),
        key.alias("zone"),
        F.array(_at(x, y, (0, 0), (12, 0), (12, 4), (0, 4))).alias("rings"),
    )


def span_sql(start: str, step: str, low: str, high: str) -> tuple[str, str]:
    """Entry and exit of a moving coordinate into [low, high], as positions along the segment."""
    return (
        f"CASE WHEN {step} = 0 THEN CASE WHEN {start} BETWEEN {low} AND {high} THEN 0.0::DOUBLE ELSE 2.0::DOUBLE END"
        f" ELSE least(({low} - {start}) / {step}, ({high} - {start}) / {step}) END",
        f"CASE WHEN {step} = 0 THEN 1.0::DOUBLE"
        f" ELSE greatest(({low} - {start}) / {step}, ({high} - {start}) / {step}) END",
    )


X_IN, X_OUT = span_sql("x1", "(x2 - x1)", "zx", "zx + 12")
Y_IN, Y_OUT = span_sql("y1", "(y2 - y1)", "zy", "zy + 4")


@register(
    f"""WITH {ZONES_SQL},
    corners AS (SELECT o_orderkey AS street,
      (o_orderkey % 240) / 4.0::DOUBLE + 0.125 AS ax, (o_custkey % 80) / 4.0::DOUBLE + 0.125 AS ay,
      (o_custkey % 232) / 4.0::DOUBLE + 0.125 AS bx, (o_orderkey % 72) / 4.0::DOUBLE + 0.125 AS b_y,
      (o_orderkey * 7 % 240) / 4.0::DOUBLE + 0.125 AS dx, (o_custkey * 3 % 80) / 4.0::DOUBLE + 0.125 AS dy FROM orders),
    segments AS (SELECT street, ax AS x1, ay AS y1, bx AS x2, b_y AS y2 FROM corners
      UNION ALL SELECT street, bx, b_y, dx, dy FROM corners),
    spans AS (SELECT *, greatest(0.0::DOUBLE, {X_IN}, {Y_IN}) AS t0, least(1.0::DOUBLE, {X_OUT}, {Y_OUT}) AS t1
      FROM segments, zones WHERE x1 <> x2 OR y1 <> y2)
    SELECT street, n_nationkey AS zone, round(sum((t1 - t0) * sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)), 6) AS length
    FROM spans WHERE t1 - t0 > 1e-12 GROUP BY ALL"""
)
def streets_clipped_to_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    clipped = ops.clip_lines(lines(spark, sf_dir), box_zones(spark, sf_dir), "street", ["zone"])
    return clipped.select("street", "zone", round_even(geo.length(c("parts")), 6).alias("length"))


# The shapes as sums of convex pieces: a box, a box below a slope, two boxes, a box less an open box.
# An open side leaves out what runs along it. Each piece is the part of a segment between two positions.
PIECES_SQL = f"""{ZONES_SQL},
    pieces AS (SELECT n_nationkey, n_name, zx, zy, unnest(CASE n_nationkey % 4
        WHEN 0 THEN [{{'sign': 1, 'x0': 0, 'x1': 12, 'y0': 0, 'y1': 4, 'slope': false, 'open': false, 'floor': false}}]
        WHEN 1 THEN [{{'sign': 1, 'x0': 0, 'x1': 12, 'y0': 0, 'y1': 4, 'slope': true, 'open': false, 'floor': false}}]
        WHEN 2 THEN [{{'sign': 1, 'x0': 0, 'x1': 12, 'y0': 0, 'y1': 2, 'slope': false, 'open': false, 'floor': false}},
                     {{'sign': 1, 'x0': 0, 'x1': 6, 'y0': 2, 'y1': 4, 'slope': false, 'open': false, 'floor': true}}]
        ELSE [{{'sign': 1, 'x0': 0, 'x1': 12, 'y0': 0, 'y1': 4, 'slope': false, 'open': false, 'floor': false}},
              {{'sign': -1, 'x0': 3, 'x1': 9, 'y0': 1, 'y1': 3, 'slope': false, 'open': true, 'floor': true}}] END, recursive := true)
      FROM zones),
    placed AS (SELECT n_nationkey, n_name, sign, slope, open, floor, zx, zy, zx + x0 AS bx0, zx + x1 AS bx1, zy + y0 AS by0, zy + y1 AS by1 FROM pieces)"""


def inside_sql(start: str, step: str, low: str, high: str, open_low: str, open_high: str) -> tuple[str, str]:
    """Like ``span_sql``, where a segment along an open side is outside."""
    flat = f"({start} > {low} OR ({start} = {low} AND NOT {open_low})) AND ({start} < {high} OR ({start} = {high} AND NOT {open_high}))"
    return (
        f"CASE WHEN {step} = 0 THEN CASE WHEN {flat} THEN 0.0::DOUBLE ELSE 2.0::DOUBLE END"
        f" ELSE least(({low} - {start}) / {step}, ({high} - {start}) / {step}) END",
        f"CASE WHEN {step} = 0 THEN 1.0::DOUBLE ELSE greatest(({low} - {start}) / {step}, ({high} - {start}) / {step}) END",
    )


SHAPE_X = inside_sql("x1", "(x2 - x1)", "bx0", "bx1", "open", "open")
SHAPE_Y = inside_sql("y1", "(y2 - y1)", "by0", "by1", "floor", "open")
# Above 0 on and below the slope from the lower left to the upper right corner.
RISE, GAIN = "((x1 - zx) - 3 * (y1 - zy))", "((x2 - x1) - 3 * (y2 - y1))"
SLOPE = (
    f"CASE WHEN NOT slope OR {GAIN} < 0 THEN 0.0::DOUBLE WHEN {GAIN} > 0 THEN -{RISE} / {GAIN} WHEN {RISE} >= 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE END",
    f"CASE WHEN slope AND {GAIN} < 0 THEN -{RISE} / {GAIN} ELSE 1.0::DOUBLE END",
)


def shapes_sql(corners: str) -> str:
    return f"""WITH {PIECES_SQL}, corners AS ({corners}),
    segments AS (SELECT street, ax AS x1, ay AS y1, bx AS x2, b_y AS y2 FROM corners
      UNION ALL SELECT street, bx, b_y, dx, dy FROM corners),
    spans AS (SELECT *, greatest(0.0::DOUBLE, {SHAPE_X[0]}, {SHAPE_Y[0]}, {SLOPE[0]}) AS t0,
        least(1.0::DOUBLE, {SHAPE_X[1]}, {SHAPE_Y[1]}, {SLOPE[1]}) AS t1
      FROM segments, placed WHERE x1 <> x2 OR y1 <> y2),
    shares AS (SELECT street, n_nationkey, n_name, sign * greatest(t1 - t0, 0) AS share, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS full_length FROM spans)
    SELECT street, n_nationkey AS zone, n_name AS zone_name, round(sum(share * full_length), 6) AS length
    FROM shares GROUP BY ALL HAVING sum(share * full_length) > 1e-9"""


def _clipped_to_shapes(spark: SparkSession, sf_dir: str, streets: DataFrame) -> DataFrame:
    clipped = ops.clip_lines(streets, nation_zones(spark, sf_dir), "street", ["zone", "zone_name"])
    return clipped.select("street", "zone", "zone_name", round_even(geo.length(c("parts")), 6).alias("length"))


@register(
    shapes_sql(
        """SELECT o_orderkey AS street,
      (o_orderkey % 240) / 4.0::DOUBLE + 0.125 AS ax, (o_custkey % 80) / 4.0::DOUBLE + 0.125 AS ay,
      (o_custkey % 232) / 4.0::DOUBLE + 0.125 AS bx, (o_orderkey % 72) / 4.0::DOUBLE + 0.125 AS b_y,
      (o_orderkey * 7 % 240) / 4.0::DOUBLE + 0.125 AS dx, (o_custkey * 3 % 80) / 4.0::DOUBLE + 0.125 AS dy FROM orders"""
    )
)
def streets_clipped_to_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles, L-shapes and holes."""
    return _clipped_to_shapes(spark, sf_dir, lines(spark, sf_dir))


@register(
    shapes_sql(
        """SELECT o_orderkey AS street, (o_orderkey % 61)::DOUBLE AS ax, (o_custkey % 21)::DOUBLE AS ay,
      (o_custkey * 3 % 61)::DOUBLE AS bx, (o_custkey % 21)::DOUBLE AS b_y,
      (o_custkey * 3 % 61)::DOUBLE AS dx, (o_orderkey * 5 % 21)::DOUBLE AS dy FROM orders"""
    )
)
def border_streets_clipped_to_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streets of one level and one upright segment on whole numbers: many run along borders, some have no length."""
    key, customer = c("o_orderkey"), c("o_custkey")
    a = geo.point(key % 61, customer % 21)
    b = geo.point(customer * 3 % 61, customer % 21)
    d = geo.point(customer * 3 % 61, key * 5 % 21)
    streets = table(spark, sf_dir, "orders").select(key.alias("street"), F.array(F.array(a, b, d)).alias("parts"))
    return _clipped_to_shapes(spark, sf_dir, streets)


@register(
    f"""WITH {POINTS_SQL},
    places AS (SELECT DISTINCT px, py FROM points WHERE px IS NOT NULL AND py IS NOT NULL),
    boxes AS (SELECT p_partkey AS feature_index, 'p' || p_partkey AS zone, (p_partkey * 7 % 240) / 4.0::DOUBLE AS x0,
        (p_partkey * 7 % 240) / 4.0::DOUBLE + 0.5 AS x1, (p_partkey * 11 % 83) / 4.0::DOUBLE AS y0, (p_partkey * 11 % 83) / 4.0::DOUBLE + 0.25 AS y1 FROM part
      UNION ALL SELECT 1000000000 + r_regionkey, 'r' || r_regionkey, r_regionkey * 4.0::DOUBLE, r_regionkey * 4.0::DOUBLE + 44, 0.0, 20.0 FROM region),
    hits AS (SELECT px, py, arg_min(zone, feature_index) AS zone FROM places JOIN boxes ON px BETWEEN x0 AND x1 AND py BETWEEN y0 AND y1 GROUP BY px, py)
    SELECT points.*, zone FROM points LEFT JOIN hits USING (px, py)"""
)
def points_in_mixed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of small blocks on top of a few zones as large as the map."""
    x, y = (c("p_partkey") * 7 % 240) / 4.0, (c("p_partkey") * 11 % 83) / 4.0
    blocks = table(spark, sf_dir, "part").select(
        c("p_partkey").alias("feature_index"),
        F.concat(F.lit("p"), c("p_partkey")).alias("zone"),
        F.array(_at(x, y, (0, 0), (0.5, 0), (0.5, 0.25), (0, 0.25))).alias("rings"),
    )
    left = c("r_regionkey") * 4.0
    wide = table(spark, sf_dir, "region").select(
        (F.lit(1000000000) + c("r_regionkey")).alias("feature_index"),
        F.concat(F.lit("r"), c("r_regionkey")).alias("zone"),
        F.array(_at(left, F.lit(0.0), (0, 0), (44, 0), (44, 20), (0, 20))).alias("rings"),
    )
    return ops.spatial_join(points(spark, sf_dir), blocks.union(wide), {"zone": "zone"}, "px", "py")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as noise and air cells; some have no area, some lie off the map."""
    x, y = (c("l_orderkey") % 260) / 4.0 - 2, (c("l_partkey") % 92) / 4.0 - 1
    return table(spark, sf_dir, "lineitem").select(
        (10 * (c("l_linenumber") % 3 + 1) + c("l_suppkey") % 3 + 1).cast("int").alias("category"),
        x.alias("minx"),
        y.alias("miny"),
        (x + F.floor(c("l_quantity") / 10) / 2).alias("maxx"),
        (y + (c("l_linenumber") - 1) / 4.0).alias("maxy"),
    )


CELLS_SQL = f"""{ZONES_SQL},
raw_cells AS (SELECT CAST(10 * (l_linenumber % 3 + 1) + l_suppkey % 3 + 1 AS INTEGER) AS category,
    (l_orderkey % 260) / 4.0::DOUBLE - 2 AS minx, (l_partkey % 92) / 4.0::DOUBLE - 1 AS miny,
    (l_orderkey % 260) / 4.0::DOUBLE - 2 + floor(l_quantity / 10) / 2 AS maxx,
    (l_partkey % 92) / 4.0::DOUBLE - 1 + (l_linenumber - 1) / 4.0::DOUBLE AS maxy FROM lineitem),
cells AS (SELECT *, (minx + maxx) / 2 AS center_x, (miny + maxy) / 2 AS center_y, (maxx - minx) * (maxy - miny) AS area
    FROM raw_cells WHERE maxx >= 0 AND minx <= 60 AND maxy >= 0 AND miny <= 20 AND (maxx - minx) * (maxy - miny) > 0),
places AS (SELECT DISTINCT center_x AS px, center_y AS py FROM cells),
hits AS (SELECT px, py, min(n_nationkey) AS zone FROM places JOIN zones ON {ZONE_HIT_SQL} GROUP BY px, py),
assigned AS (SELECT cells.*, zone FROM cells LEFT JOIN hits ON px = center_x AND py = center_y)"""


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.prepare_cells(cells(spark, sf_dir), (0, 0, 60, 20))


@register(f"WITH {CELLS_SQL} SELECT * FROM cells")
def prepared_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir)


@register(f"WITH {CELLS_SQL} SELECT * FROM assigned")
def cells_in_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.assign_cells(prepared(spark, sf_dir), nation_zones(spark, sf_dir), "zone")


@register(
    f"""WITH {CELLS_SQL}, odd AS (SELECT * REPLACE (
        CASE l_linenumber WHEN 5 THEN 'nan'::DOUBLE WHEN 6 THEN 'inf'::DOUBLE ELSE maxx END AS maxx,
        CASE l_linenumber WHEN 4 THEN 'nan'::DOUBLE WHEN 3 THEN miny - 1 ELSE maxy END AS maxy,
        CASE l_linenumber WHEN 7 THEN '-inf'::DOUBLE ELSE minx END AS minx)
      FROM (SELECT l_orderkey, l_linenumber, (l_orderkey % 260) / 4.0::DOUBLE - 2 AS minx, (l_partkey % 92) / 4.0::DOUBLE - 1 AS miny,
        (l_orderkey % 260) / 4.0::DOUBLE - 1 AS maxx, (l_partkey % 92) / 4.0::DOUBLE AS maxy FROM lineitem))
    SELECT *, (minx + maxx) / 2 AS center_x, (miny + maxy) / 2 AS center_y, (maxx - minx) * (maxy - miny) AS area
    FROM odd WHERE isfinite(minx) AND isfinite(miny) AND isfinite(maxx) AND isfinite(maxy) AND maxx > minx AND maxy > miny"""
)
def cells_with_finite_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sides that are no numbers, infinite or the wrong way round leave no cell."""
    line, x, y = c("l_linenumber"), (c("l_orderkey") % 260) / 4.0, (c("l_partkey") % 92) / 4.0
    odd = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(line == 7, F.lit(float("-inf"))).otherwise(x - 2).alias("minx"),
        (y - 1).alias("miny"),
        F.when(line == 5, F.lit(float("nan"))).when(line == 6, F.lit(float("inf"))).otherwise(x - 1).alias("maxx"),
        F.when(line == 4, F.lit(float("nan"))).when(line == 3, y - 2).otherwise(y).alias("maxy"),
    )
    return ops.prepare_cells(odd)
