"""Point-in-polygon join and line clipping over a grid.

A range predicate alone would plan a nested loop over all (point, zone) pairs. Instead zones are
listed by grid cell (``zone_index``), and points and the stretches of lines meet them by equality of the cell.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.functions import geo
from citygrain.functions.numbers import where_once
from citygrain.operators.zone_arrays import EDGE, MOST_PAIRS, ZoneArrays, counted, slices, zone_arrays
from citygrain.operators.zone_index import STEP, cell, with_edges, zone_index
from citygrain.session import BROADCAST_BYTES, staged

#: Up to this many zones may meet in one cell, and zones be listed at this many levels, and still be tried in place.
MAX_CANDIDATES = 512
MAX_LEVELS = 8

#: Positions along a segment that are closer than this are one.
NEAR = 1e-12

#: Lines are followed through cells that are cut this often at most.
LINE_SPLITS = 2

#: Rows of one batch that a walk hands on.
MOST_ROWS = 100_000

#: A line with more points is cut by many tasks.
LONG_LINE = 100_000

EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def _hit(candidate: Column, x: Column, y: Column) -> Column:
    box = candidate["_box"]
    return candidate["_inside"] | (
        x.between(box["minx"], box["maxx"])
        & y.between(box["miny"], box["maxy"])
        & geo.covers(candidate["_edges"], x, y)
    )


def _measured(index: DataFrame) -> tuple[list[int], int, int]:
    """Levels of an index, most zones in one cell, and about its bytes."""
    edges = F.coalesce(F.size("_edges"), F.lit(0))
    weight = index.groupBy("_level", "_cx", "_cy").agg(F.count(F.lit(1)).alias("n"), F.sum(edges + 8).alias("edges"))
    rows = weight.groupBy("_level").agg(F.max("n").alias("most"), F.sum("edges").alias("edges")).collect()
    return sorted(row["_level"] for row in rows), max((row["most"] for row in rows), default=0), 40 * sum(row["edges"] for row in rows)


def spatial_join(
    points: DataFrame,
    zones: DataFrame,
    properties: dict[str, str],
    x: str = "longitude",
    y: str = "latitude",
    order: str = "feature_index",
    rings: str = "rings",
    level: int | None = None,
    max_candidates: int = MAX_CANDIDATES,
) -> DataFrame:
    """Give every point the properties of the first zone, by ``order``, that covers it.

    ``properties`` maps zone columns to output columns. The boundary belongs to the zone. A point
    without coordinates or without a zone gets NULLs; every point keeps exactly one row. The
    points are not shuffled where the zone index is small enough to broadcast: they look their cell
    up once per level, a batch of them at a time.
    """
    props = F.struct(*[F.col(name).alias(out) for name, out in properties.items()])
    # Zones with equal outlines cover the same points, so only the first of them can be found: the rest
    # are dropped before the index, which piles of copies would otherwise fill. Zones without an order stay.
    drawn = zones.where(F.size(rings) > 0)
    first_copy = F.min(F.struct(F.col(order).alias("_order"), props.alias("_props"))).alias("_first")
    shapes = drawn.where(F.col(order).isNotNull()).groupBy(F.col(rings).alias("_rings")).agg(first_copy)
    shapes = shapes.select("_first._order", "_first._props", F.col("_rings").alias(rings))
    unordered = drawn.where(F.col(order).isNull()).select(F.col(order).alias("_order"), props.alias("_props"), rings)
    layer = with_edges(shapes.unionByName(unordered), rings).withColumn("_id", F.monotonically_increasing_id())
    # Cells well below a zone's size: most points then lie in cells that a zone covers, and meet no edge.
    index = zone_index(layer.select("_id", "_order", "_box", "_edges", "_props"), level, finer=STEP)
    levels, most, size = _measured(index)
    zone = ["_order", "_inside", "_box", "_edges", "_props"]
    # A point with a coordinate that is no finite number lies in no cell.
    most_value = F.lit(sys.float_info.max)
    px, py = F.col(f"`{x}`"), F.col(f"`{y}`")
    known = px.cast("double").between(-most_value, most_value) & py.cast("double").between(-most_value, most_value)
    if most > max_candidates or size > BROADCAST_BYTES or len(levels) > MAX_LEVELS:
        return _join_by_pairs(points, known, index.select("_level", "_cx", "_cy", F.struct(*zone).alias("_zone")), levels, properties, x, y)

    kept = [F.col(f"`{name}`") for name in points.columns]
    if not levels:
        kinds = {field.name: field.dataType for field in zones.schema}
        return points.select(*kept, *[F.lit(None).cast(kinds[name]).alias(out) for name, out in properties.items()])
    sent = points.sparkSession.sparkContext.broadcast(zone_arrays(index, zone))

    @F.arrow_udf("long")
    def first_zone(xs: pa.Array, ys: pa.Array) -> pa.Array:
        arrays = sent.value
        found = arrays.first_zones(*(values.to_numpy(zero_copy_only=False).astype(float) for values in (xs, ys)))
        return pa.array(arrays.ident[found], mask=found < 0)

    # An index has a row for each cell of a zone: any of them tells the zone's properties.
    named = index.groupBy(F.col("_id").alias("_found")).agg(F.first("_props").alias("_props"))
    numbered = points.withColumn("_found", first_zone(*(F.when(known, value.cast("double")) for value in (px, py))))
    return numbered.join(F.broadcast(named), "_found", "left").select(*kept, "_props.*")


def _join_by_pairs(
    points: DataFrame, known: Column, index: DataFrame, levels: list[int], properties: dict[str, str], x: str, y: str
) -> DataFrame:
    """The same for an index that is large or piles up in single cells: distinct positions meet single zones.

    The first zone is a minimum, combined map-side, so no list is built whatever the pile.
    """
    px, py = F.col(f"`{x}`"), F.col(f"`{y}`")
    places = points.where(known).select(px.alias("_x"), py.alias("_y")).dropDuplicates()
    keys = [
        F.struct(F.lit(own).alias("_level"), cell(F.col("_x"), 2.0**own).alias("_cx"), cell(F.col("_y"), 2.0**own).alias("_cy"))
        for own in levels
    ]
    first = (
        places.withColumn("_key", F.explode(F.array(*keys)))
        .select("_x", "_y", "_key.*")
        .join(index, ["_level", "_cx", "_cy"])
        .where(_hit(F.col("_zone"), F.col("_x"), F.col("_y")))
        .groupBy("_x", "_y")
        .agg(F.min_by("_zone._props", "_zone._order").alias("_props"))
    )
    joined = points.join(first, (px == F.col("_x")) & (py == F.col("_y")), "left")
    return joined.select(*[F.col(f"`{name}`") for name in points.columns], "_props.*")


def _at(p: Column, q: Column, t: Column) -> Column:
    """The point at position ``t`` of the way from p to q; its ends are p and q themselves."""
    between = geo.point(p["x"] + t * (q["x"] - p["x"]), p["y"] + t * (q["y"] - p["y"]))
    return F.when(t == 0.0, p).when(t == 1.0, q).otherwise(between)


def _pairs(stops: Column) -> Column:
    """Neighbours in an array as STRUCT<s, t>."""
    return F.zip_with(
        F.slice(stops, F.lit(1), F.size(stops) - 1),
        F.slice(stops, F.lit(2), F.size(stops) - 1),
        lambda s, t: F.struct(s.alias("s"), t.alias("t")),
    )


def _number(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False) for name in names]


def _spans(rows: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to) between neighbouring different stops of a row."""
    order = np.lexsort((stops, rows))
    rows, stops = rows[order], stops[order]
    kept = np.flatnonzero((rows[1:] == rows[:-1]) & (stops[1:] > stops[:-1]))
    return rows[kept], stops[kept], stops[kept + 1]


SEGMENT = ["_px", "_py", "_qx", "_qy"]


def _walked(ends: list[np.ndarray], size: float, extent: tuple[float, float, float, float]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Segments through the cells of one size: the row of each stretch, and where the stretch lies.

    Only what lies in the layer's box, and a cell more, is walked.
    """
    px, py, qx, qy = ends
    begin, end, borders = np.zeros(len(px)), np.ones(len(px)), []
    with np.errstate(divide="ignore", invalid="ignore"):
        for p, q, low, high in ((px, qx, extent[0] - size, extent[2] + size), (py, qy, extent[1] - size, extent[3] + size)):
            step = q - p
            one, other = (low - p) / step, (high - p) / step
            begin = np.where(step != 0, np.fmax(begin, np.fmin(one, other)), np.where((p >= low) & (p <= high), begin, 2.0))
            end = np.where(step != 0, np.fmin(end, np.fmax(one, other)), end)
            least = np.floor(np.clip(np.minimum(p, q), low, high) / size) + 1
            most = np.floor(np.clip(np.maximum(p, q), low, high) / size)
            row, number = counted(least.astype(np.int64), np.where(step != 0, np.maximum(most - least + 1, 0), 0).astype(np.int64))
            borders.append((row, (number * size - p[row]) / step[row]))
    inner, at = np.concatenate([row for row, _ in borders]), np.concatenate([t for _, t in borders])
    met = (at > begin[inner]) & (at < end[inner])
    some = np.flatnonzero(begin < end)
    row, s, t = _spans(np.concatenate([some, some, inner[met]]), np.concatenate([begin[some], end[some], at[met]]))
    half = (s + t) / 2
    cells = [np.floor((p[row] + half * (q - p)[row]) / size).astype(np.int64) for p, q in ((px, qx), (py, qy))]
    return row, {"_from": s, "_to": t, "_cx": cells[0], "_cy": cells[1]}


STRETCH = "_px double, _py double, _qx double, _qy double, _from double, _to double, _level int, _cx long, _cy long"


def _stretches(segments: DataFrame, levels: list[int], extent: tuple[float, float, float, float]) -> DataFrame:
    """Segments walked through the cells of every level that the index has."""
    others = [name for name in segments.columns if name not in SEGMENT]
    types = {field.name: field.dataType.simpleString() for field in segments.schema}

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for level in levels:
                row, found = _walked(_number(batch, *SEGMENT), 2.0**level, extent)
                for low in range(0, len(row), MOST_ROWS):
                    part = slice(low, low + MOST_ROWS)
                    rows = batch.select([*others, *SEGMENT]).take(pa.array(row[part]))
                    own = [*rows.columns, *(pa.array(found[name][part]) for name in ("_from", "_to"))]
                    own += [pa.array(np.full(rows.num_rows, level, np.int32)), pa.array(found["_cx"][part]), pa.array(found["_cy"][part])]
                    yield pa.RecordBatch.from_arrays(own, [*others, *SEGMENT, "_from", "_to", "_level", "_cx", "_cy"])

    return segments.mapInArrow(walked, ", ".join([*(f"`{name}` {types[name]}" for name in others), STRETCH]))


def _kept(
    ends: list[np.ndarray], begin: np.ndarray, end: np.ndarray, covered: np.ndarray, first: np.ndarray, count: np.ndarray, edges: tuple[np.ndarray, ...]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to) of the parts of stretches that lie inside their zone.

    A stretch has ``count`` of the ``edges``, from its ``first`` on; ``covered`` tells that its zone covers its cell.
    """
    px, py, qx, qy = ends
    dx, dy = qx - px, qy - py
    x1, y1, x2, y2 = edges

    # Where a segment meets an edge near the stretch: one position, or the two ends of an edge along it.
    row, edge = counted(first, count)
    ax, ay, bx, by = (values[edge] - start[row] for values, start in ((x1, px), (y1, py), (x2, px), (y2, py)))
    one, other = dx[row] * ay - dy[row] * ax, dx[row] * by - dy[row] * bx
    near = (np.minimum(one, other) <= 0) & (np.maximum(one, other) >= 0)
    for a, b, step in ((ax, bx, dx), (ay, by, dy)):
        low, high = np.minimum(begin * step, end * step), np.maximum(begin * step, end * step)
        slack = 4e-16 * np.abs(step)  # ends of a stretch are rounded
        near &= (np.maximum(a, b) >= (low - slack)[row]) & (np.minimum(a, b) <= (high + slack)[row])
    row, ax, ay, bx, by, one, other = (values[near] for values in (row, ax, ay, bx, by, one, other))
    square = (dx * dx + dy * dy)[row]
    on_line = (one == 0) & (other == 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        along = (ax * (by - ay) - ay * (bx - ax)) / (dx[row] * (by - ay) - dy[row] * (bx - ax))
    t1, t2 = ((x * dx[row] + y * dy[row]) / square for x, y in ((ax, ay), (bx, by)))
    low, high = np.where(on_line, np.minimum(t1, t2), along), np.where(on_line, np.maximum(t1, t2), along)
    stops, cuts = np.concatenate([row, row]), np.concatenate([low, high])
    met = (cuts > begin[stops]) & (cuts < end[stops])
    every = np.arange(len(px))
    rows, s, t = _spans(np.concatenate([every, every, stops[met]]), np.concatenate([begin, end, cuts[met]]))

    # What runs along an edge is inside; for the rest its middle speaks, which lies on no edge.
    half = (s + t) / 2
    x, y = px[rows] + half * dx[rows], py[rows] + half * dy[rows]
    span, edge = counted(first[rows], count[rows])
    turned = (y1[edge] > y[span]) != (y2[edge] > y[span])
    span, edge = span[turned], edge[turned]
    left = (x2 - x1)[edge] * (y[span] - y1[edge]) - (y2 - y1)[edge] * (x[span] - x1[edge]) > 0
    inside = np.bincount(span[left == (y2[edge] > y1[edge])], minlength=len(rows)) % 2 == 1
    inside |= covered[rows]
    begins = np.searchsorted(rows, row[on_line])
    span, _ = counted(np.zeros(on_line.sum(), np.int64), np.searchsorted(rows, row[on_line], side="right") - begins)
    place = begins[span] + np.arange(len(span)) - np.searchsorted(span, span)
    within = (half[place] >= low[on_line][span]) & (half[place] <= high[on_line][span])
    inside[place[within]] = True
    return rows[inside], s[inside], t[inside]


def _inner_spans(met: DataFrame, others: list[str]) -> DataFrame:
    """The parts of stretches that lie inside their zone, as _s and _t.

    Interpreted array functions take a hundred times as long for this as whole batches of edges do.
    """
    types = {field.name: field.dataType.simpleString() for field in met.schema}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_edges")
            count = np.diff(lists.offsets.to_numpy())
            edges = tuple(lists.flatten().field(name).to_numpy(zero_copy_only=False) for name in EDGE)
            covered = batch.column("_inside").to_numpy(zero_copy_only=False)
            row, s, t = _kept(_number(batch, *SEGMENT), *_number(batch, "_from", "_to"), covered, np.cumsum(count) - count, count, edges)
            rows = batch.select([*others, *SEGMENT]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(s), pa.array(t)], [*others, *SEGMENT, "_s", "_t"])

    edges = met.withColumn("_edges", F.coalesce("_edges", F.array().cast(EDGES)))
    schema = [*(f"`{name}` {types[name]}" for name in others), *(f"{name} double" for name in (*SEGMENT, "_s", "_t"))]
    return edges.select(*others, *SEGMENT, "_from", "_to", "_inside", "_edges").mapInArrow(cut, ", ".join(schema))


def _corners(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Segments of lines, in order: the line and the part of each, and where it begins and ends."""
    parts_of = pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = lines.flatten()
    points_of = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    points = parts.flatten()
    xs, ys = (np.asarray(pc.struct_field(points, name).to_numpy(zero_copy_only=False), float) for name in ("x", "y"))
    part = np.repeat(np.arange(len(parts)), points_of)
    line = np.repeat(np.arange(len(lines)), parts_of)
    begin = np.flatnonzero(part[1:] == part[:-1])
    ends = [xs[begin], ys[begin], xs[begin + 1], ys[begin + 1]]
    # Without a length, or a number, there is nothing to cut.
    kept = ~np.isnan(ends).any(axis=0) & ((ends[0] != ends[2]) | (ends[1] != ends[3]))
    part = part[begin[kept]]
    return line[part], part, [values[kept] for values in ends]


def _inner_parts(ends: list[np.ndarray], arrays: ZoneArrays, extent: tuple[float, float, float, float]) -> tuple[np.ndarray, ...]:
    """(segment, zone, from, to) of what lies inside zones, cell by cell."""
    found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))]
    for level in sorted(arrays.cells):
        size = 2.0**level
        crossed = 2 + sum(
            np.abs(np.clip(q, low - size, high + size) - np.clip(p, low - size, high + size)) / size
            for p, q, low, high in ((ends[0], ends[2], extent[0], extent[2]), (ends[1], ends[3], extent[1], extent[3]))
        )
        for some in slices(crossed, MOST_PAIRS):
            row, walked = _walked([values[some] for values in ends], size, extent)
            row = row + some.start
            first, count = arrays.cells[level].find(walked["_cx"], walked["_cy"])
            for part in slices(count, MOST_PAIRS):
                stretch, zone = counted(first[part], count[part])
                stretch += part.start
                own, begin, end = row[stretch], walked["_from"][stretch], walked["_to"][stretch]
                px, py, qx, qy = (values[own] for values in ends)
                minx, miny, maxx, maxy = (values[zone] for values in arrays.box)
                # A stretch that meets a zone's box in one point alone has no length in the zone.
                kept = np.ones(len(own), bool)
                for p, q, low, high in ((px, qx, minx, maxx), (py, qy, miny, maxy)):
                    one, other = p + begin * (q - p), p + end * (q - p)
                    kept &= (p == q) | (np.minimum(np.maximum(one, other), high) > np.maximum(np.minimum(one, other), low))
                own, zone, begin, end = own[kept], zone[kept], begin[kept], end[kept]
                for few in slices(arrays.count[zone], MOST_PAIRS):
                    own_ends, met = [values[own[few]] for values in ends], zone[few]
                    inner, s, t = _kept(own_ends, begin[few], end[few], arrays.inside[met], arrays.first[met], arrays.count[met], arrays.edges)
                    found.append((own[few][inner], met[inner], s, t))
    return tuple(np.concatenate(values) for values in zip(*found))


def _chained(
    line: np.ndarray, part: np.ndarray, ends: list[np.ndarray], arrays: ZoneArrays, inner: tuple[np.ndarray, ...]
) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(line, zone, parts): the spans of a line put together, in order along it; lines come in order, and zones of a line in theirs."""
    seg, zone, s, t = inner
    px, py, qx, qy = ends
    order = np.where(np.isnan(arrays.rank), -1.0, arrays.rank)[zone]
    sort = np.lexsort((s, seg, order, line[seg]))
    seg, zone, s, t, order = seg[sort], zone[sort], s[sort], t[sort], order[sort]
    # A chain goes on where a span begins where the one before it ended.
    before, after = seg[:-1], seg[1:]
    goes_on = (line[before] == line[after]) & (order[:-1] == order[1:]) & (part[before] == part[after])
    same = (before == after) & (s[1:] - t[:-1] <= NEAR)
    turned = (before < after) & (t[:-1] == 1.0) & (s[1:] == 0.0) & (qx[before] == px[after]) & (qy[before] == py[after])
    chain = np.cumsum(np.concatenate([np.ones(min(len(seg), 1), bool), ~(goes_on & (same | turned))]))

    alike = arrays.alike[zone]
    sort = np.lexsort((seg, chain, alike, line[seg]))
    seg, zone, s, t, chain, alike = (values[sort] for values in (seg, zone, s, t, chain, alike))
    changed = (np.diff(seg) != 0) | (np.diff(chain) != 0) | (np.diff(alike) != 0)
    head = np.flatnonzero(np.concatenate([np.ones(min(len(seg), 1), bool), changed]))
    if len(head):
        s, t = np.minimum.reduceat(s, head), np.maximum.reduceat(t, head)
    long = t - s > NEAR if len(head) else np.zeros(0, bool)
    seg, zone, chain, alike = (values[head][long] for values in (seg, zone, chain, alike))
    s, t = s[long], t[long]

    # One point more than pieces in each chain: where its first piece begins, and where each piece ends.
    starts = np.ones(min(len(seg), 1), bool)
    heads = np.concatenate([starts, (np.diff(chain) != 0) | (np.diff(alike) != 0)])
    rows = np.concatenate([starts, (np.diff(line[seg]) != 0) | (np.diff(alike) != 0)])
    place = np.arange(len(seg)) + np.cumsum(heads)
    points = [np.empty(len(seg) + int(heads.sum())) for _ in range(2)]
    for values, p, q in zip(points, (px, py), (qx, qy)):
        p, q = p[seg], q[seg]
        begin, end = (np.where(at == 0.0, p, np.where(at == 1.0, q, p + at * (q - p))) for at in (s, t))
        values[place] = end
        values[place[heads] - 1] = begin[heads]
    first_point, first_chain = place[heads] - 1, np.cumsum(heads)[rows] - 1
    inner_lists = pa.ListArray.from_arrays(pa.array(np.append(first_point, len(points[0])), pa.int32()), pa.StructArray.from_arrays([pa.array(values) for values in points], ["x", "y"]))
    outer_lists = pa.ListArray.from_arrays(pa.array(np.append(first_chain, len(first_point)), pa.int32()), inner_lists)
    return line[seg][rows], zone[rows], outer_lists


def _cut_in_place(lines: DataFrame, arrays: ZoneArrays, extent: tuple[float, float, float, float], parts: str) -> DataFrame:
    """Lines cut by the tasks that hold them: rows (the other columns of a line, _found, parts)."""
    others = [name for name in lines.columns if name != parts]
    types = {field.name: field.dataType.simpleString() for field in lines.schema}
    sent = lines.sparkSession.sparkContext.broadcast(arrays)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            line, part, ends = _corners(batch.column(parts))
            row, zone, clipped = _chained(line, part, ends, sent.value, _inner_parts(ends, sent.value, extent))
            for low in range(0, len(row), MOST_ROWS):
                some = slice(low, low + MOST_ROWS)
                rows = batch.select(others).take(pa.array(row[some]))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sent.value.ident[zone[some]]), clipped[some]], [*others, "_found", "parts"])

    return lines.select(*others, parts).mapInArrow(cut, ", ".join([*(f"`{name}` {types[name]}" for name in others), "_found long", f"parts {geo.GEOMETRY}"]))


def clip_lines(
    lines: DataFrame,
    zones: DataFrame,
    line_id: str,
    zone_columns: list[str],
    parts: str = "parts",
    order: str = "feature_index",
    rings: str = "rings",
    level: int | None = None,
    carried: Sequence[str] = (),
    in_ranges: bool = False,
    long_line: int = LONG_LINE,
) -> DataFrame:
    """Cut every line to every zone it runs through: rows (line id, zone columns, parts).

    Only stretches of positive length stay, so a line that merely touches a zone has no row for
    it. Segments are walked through the cells they cross; a stretch meets the zones listed in its cell,
    is whole where the zone covers the cell, and is cut at the few edges of the cell otherwise. The
    spans of a zone are put together again by their positions along the line, so cells leave no trace
    in the result. Work grows with the cells crossed, for lines and outlines of any size.

    The rows also get the columns ``carried`` from the lines of the same id, as a join would give them; lines without an id have none then.
    A line is cut whole by one task; ``in_ranges`` deals lines to tasks by ranges of their ids. Only lines above ``long_line`` points, ids
    that several lines share, and lines that meet an index too large to broadcast are spread over tasks by segments.
    """
    c = F.col
    if carried:
        lines = lines.where(c(line_id).isNotNull())
    lines = lines.select(line_id, *carried, parts)
    layer = with_edges(zones.where(F.size(rings) > 0), rings).withColumn("_id", F.monotonically_increasing_id())
    index = zone_index(layer.select("_id", F.col(order).alias("_order"), "_box", "_edges", *zone_columns), level, LINE_SPLITS)
    levels, _, size = _measured(index)
    box = layer.agg(F.min("_box.minx"), F.min("_box.miny"), F.max("_box.maxx"), F.max("_box.maxy")).first()
    extent = tuple(box) if levels else (0.0, 0.0, 0.0, 0.0)
    columns = [line_id, *zone_columns, "parts", *carried]

    def spread(some: DataFrame) -> DataFrame:
        cut = _cut_by_segments(some, index.drop("_id"), levels, size, extent, line_id, zone_columns, parts)
        return (cut.join(some.drop(parts), line_id) if carried else cut).select(*columns)

    if size > BROADCAST_BYTES or not levels:
        return spread(lines)
    ids = lines.groupBy(line_id).agg(F.count(F.lit(1)).alias("_lines"), F.max(F.size(F.flatten(parts))).alias("_points"))
    apart = ids.where((c("_lines") > 1) | (c("_points") > long_line)).select(line_id)
    named = index.groupBy(c("_id").alias("_found")).agg(*[F.first(name).alias(name) for name in zone_columns])
    arrays = zone_arrays(index, [*zone_columns, "_order"], zone_columns)

    def whole(some: DataFrame) -> DataFrame:
        dealt = some.repartitionByRange(line_id) if in_ranges else some.repartition(line_id)
        return _cut_in_place(dealt, arrays, extent, parts).join(F.broadcast(named), "_found").select(*columns)

    if apart.isEmpty():
        return whole(lines)
    apart = staged(apart, "lines-apart")
    known = c(f"l.`{line_id}`").eqNullSafe(c(f"a.`{line_id}`"))
    one, other = (lines.alias("l").join(apart.alias("a"), known, how) for how in ("left_anti", "left_semi"))
    return whole(one).unionByName(spread(other))


def _cut_by_segments(
    lines: DataFrame,
    index: DataFrame,
    levels: list[int],
    size: int,
    extent: tuple[float, float, float, float],
    line_id: str,
    zone_columns: list[str],
    parts: str,
) -> DataFrame:
    """Lines cut where their segments are dealt to: rows (line id, zone columns, parts)."""
    c = F.col
    segments = (
        lines.select(F.col(line_id).alias("_line"), F.posexplode(parts).alias("_part", "_points"))
        .where(F.size("_points") > 1)
        .select("_line", "_part", F.posexplode_outer(_pairs(c("_points"))).alias("_seg", "_pair"))
        .select("_line", "_part", "_seg", c("_pair.s.x").alias("_px"), c("_pair.s.y").alias("_py"), c("_pair.t.x").alias("_qx"), c("_pair.t.y").alias("_qy"))
        .where((c("_px") != c("_qx")) | (c("_py") != c("_qy")))
        # The cutting is work for the processor: segments of one long line are spread over tasks.
        .repartition("_line", "_part", "_seg")
    )
    # A stretch that meets a zone's box in one point alone has no length in the zone.
    x1, x2 = (c("_px") + c(t) * (c("_qx") - c("_px")) for t in ("_from", "_to"))
    y1, y2 = (c("_py") + c(t) * (c("_qy") - c("_py")) for t in ("_from", "_to"))
    wide = F.least(F.greatest(x1, x2), "_box.maxx") > F.greatest(F.least(x1, x2), "_box.minx")
    high = F.least(F.greatest(y1, y2), "_box.maxy") > F.greatest(F.least(y1, y2), "_box.miny")
    listed = F.broadcast(index) if size <= BROADCAST_BYTES else index
    met = _stretches(segments, levels, extent).join(listed, ["_level", "_cx", "_cy"])
    met = met.where((wide | (c("_px") == c("_qx"))) & (high | (c("_py") == c("_qy"))))
    names = {name: f"_zone{number}" for number, name in enumerate(zone_columns)}
    kept = met.withColumnsRenamed(names)
    spans = _inner_spans(kept, ["_line", "_order", *names.values(), "_part", "_seg"])

    # Spans in order along the line: a chain goes on where a span begins where the one before it ended.
    along = Window.partitionBy("_line", "_order").orderBy("_part", "_seg", "_s")
    last = F.lag(F.struct("_part", "_seg", "_t", "_qx", "_qy")).over(along)
    same = (last["_part"] == c("_part")) & (last["_seg"] == c("_seg")) & (c("_s") - last["_t"] <= NEAR)
    ended = (last["_t"] == 1.0) & (c("_s") == 0.0) & (last["_qx"] == c("_px")) & (last["_qy"] == c("_py"))
    turned = (last["_part"] == c("_part")) & (last["_seg"] < c("_seg")) & ended
    chained = spans.withColumn("_starts", F.when(same | turned, 0).otherwise(1)).withColumn("_chain", F.sum("_starts").over(along))
    own = ["_line", "_order", *names.values()]
    p, q = geo.point(c("_px"), c("_py")), geo.point(c("_qx"), c("_qy"))
    piece = F.struct("_part", "_seg", _at(p, q, c("_s")).alias("a"), _at(p, q, c("_t")).alias("b"))
    whole = (
        chained.groupBy(*own, "_chain", "_part", "_seg", *SEGMENT)
        .agg(F.min("_s").alias("_s"), F.max("_t").alias("_t"))
        .where(c("_t") - c("_s") > NEAR)
        .select(*own, "_chain", piece.alias("_piece"))
    )
    chains = whole.groupBy(*own, "_chain").agg(F.sort_array(F.collect_list("_piece")).alias("_pieces"))
    points = F.concat(F.array(c("_pieces")[0]["a"]), F.transform("_pieces", lambda one: one["b"]))
    polylines = F.sort_array(F.collect_list(F.struct("_chain", points.alias("_points"))))
    found = chains.groupBy(*own).agg(polylines.alias("_lines"))
    columns = [c(other).alias(name) for name, other in names.items()]
    return found.select(c("_line").alias(line_id), *columns, F.transform("_lines", lambda one: one["_points"]).alias("parts"))


def prepare_cells(
    cells: DataFrame, extent: tuple[float, float, float, float] | None = None, parsed: bool = False
) -> DataFrame:
    """Noise and air cells: those that touch the extent and have an area, with centre and area.

    A cell needs four finite sides, the upper ones above the lower ones. ``parsed`` tells that the sides are
    worked out by the same plan: they are bound once then. Typed sides are tested one by one, so that their
    bounds reach the scan.
    """
    c, most = F.col, F.lit(sys.float_info.max)
    sides = ("minx", "miny", "maxx", "maxy")

    def area(of: Callable[[str], Column]) -> Column:
        return (of("maxx") - of("minx")) * (of("maxy") - of("miny"))

    def tests(of: Callable[[str], Column]) -> list[Column]:
        found = [of(name).between(-most, most) for name in sides]
        if extent is not None:
            minx, miny, maxx, maxy = (F.lit(float(value)) for value in extent)
            found += [(of("maxx") >= minx) & (of("minx") <= maxx) & (of("maxy") >= miny) & (of("miny") <= maxy)]
        return [*found, (area(of) > 0) & (of("maxx") > of("minx")) & (of("maxy") > of("miny"))]

    if parsed:
        cells = where_once(cells, sides, lambda cell: reduce(and_, tests(lambda name: cell[name])))
    else:
        for test in tests(c):
            cells = cells.where(test)
    return cells.withColumns({"center_x": (c("minx") + c("maxx")) / 2, "center_y": (c("miny") + c("maxy")) / 2, "area": area(c)})


def layer_extent(zones: DataFrame, rings: str = "rings") -> tuple[float, float, float, float]:
    """Bounding box of a whole layer: one row."""
    box = geo.bounds(F.col(rings))
    row = zones.agg(
        F.min(box["minx"]), F.min(box["miny"]), F.max(box["maxx"]), F.max(box["maxy"])
    ).first()
    return tuple(row)


def assign_cells(
    cells: DataFrame, zones: DataFrame, zone_key: str, rings: str = "rings", order: str = "feature_index"
) -> DataFrame:
    """Zone of each cell's centre; both sides in the same projected metres."""
    return spatial_join(
        cells, zones, {zone_key: zone_key}, x="center_x", y="center_y", order=order, rings=rings
    )
