"""Zones by grid cell, each zone at the level of its own size and finer only where its outline is.

A cell of level ``l`` is a square of side ``2^l``, so ``floor(x / side)`` is exact. A zone begins in the few
cells that its box touches at a level near its own size. A cell that the outline doesn't cross is wholly
inside, and listed once however large, or outside, and dropped; a cell that many edges cross is cut into
sixteen. So the number of rows follows the outlines and not the areas, and layers that mix small and
large zones stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.functions import geo
from citygrain.session import staged

#: A cell that more edges cross is cut, ``SPLITS`` times at most; each cut takes two levels.
MOST_EDGES, SPLITS, STEP = 16, 8, 2

c = F.col


def with_edges(zones: DataFrame, rings: str = "rings") -> DataFrame:
    """Add the bounding box and the edges of each zone."""
    return zones.withColumn("_box", geo.bounds(F.col(rings))).withColumn("_edges", geo.edges(F.col(rings)))


def side(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def cell(value: Column, size: Column | float) -> Column:
    return F.floor(value / (F.lit(size) if isinstance(size, float) else size))


def straddles(box: dict[str, Column], x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The corners of a box are not all on one side of the line through two points."""
    sides = [(x2 - x1) * (box[y] - y1) - (y2 - y1) * (box[x] - x1) for x in ("minx", "maxx") for y in ("miny", "maxy")]
    return (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def _classified(cells: DataFrame) -> DataFrame:
    """Cells of zones with what a point of the cell needs; cells outside the zone are dropped.

    ``_edges`` become those that a ray to the right of some point of the cell can meet, and none where
    ``_inside`` says that the zone covers the whole cell. ``_crossing`` counts the edges that meet the cell.
    """
    size = side(c("_level"))
    box = {"minx": c("_left"), "miny": c("_low"), "maxx": c("_right"), "maxy": c("_high")}
    cells = cells.withColumns({"_left": c("_cx") * size, "_low": c("_cy") * size})
    cells = cells.withColumns({"_right": c("_left") + size, "_high": c("_low") + size})

    def reaches(e: Column) -> Column:
        return (
            (F.greatest(e["y1"], e["y2"]) >= box["miny"])
            & (F.least(e["y1"], e["y2"]) <= box["maxy"])
            & (F.greatest(e["x1"], e["x2"]) >= box["minx"])
        )

    def meets(e: Column) -> Column:
        return (F.least(e["x1"], e["x2"]) <= box["maxx"]) & straddles(box, e["x1"], e["y1"], e["x2"], e["y2"])

    cells = cells.withColumn("_edges", F.filter("_edges", reaches))
    cells = cells.withColumn("_crossing", F.size(F.filter("_edges", meets)))
    # Without an edge in the cell all its points are alike, so its centre speaks for them.
    centre = geo.covers(c("_edges"), c("_left") + size / 2, c("_low") + size / 2)
    cells = cells.withColumn("_inside", F.when(c("_crossing") == 0, centre).otherwise(False)).where("_crossing > 0 or _inside")
    return cells.withColumn("_edges", F.when(~c("_inside"), c("_edges"))).drop("_left", "_low", "_right", "_high")


def zone_index(zones: DataFrame, level: int | None = None, splits: int = SPLITS, finer: int = 0) -> DataFrame:
    """Rows (zone columns, _level, _cx, _cy, _inside, _crossing, _edges) of zones that have ``_box`` and ``_edges``.

    ``level`` puts all zones at one level; otherwise each has its own, ``finer`` levels below its size.
    """
    box = c("_box")
    longest = F.greatest(box["maxx"] - box["minx"], box["maxy"] - box["miny"])
    own = F.when(longest > 0, F.floor(F.log2(longest) / STEP) * STEP - finer).otherwise(0)
    leveled = zones.withColumn("_level", (F.lit(level) if level is not None else own).cast("int"))
    size = side(c("_level"))
    cells = leveled.withColumn("_cx", F.explode(F.sequence(cell(box["minx"], size), cell(box["maxx"], size))))
    cells = cells.withColumn("_cy", F.explode(F.sequence(cell(box["miny"], size), cell(box["maxy"], size))))
    coarse = staged(_classified(cells), "cells")
    whole = coarse.where(c("_crossing") <= MOST_EDGES)
    for _ in range(splits):
        crowded = coarse.where(c("_crossing") > MOST_EDGES)
        if crowded.isEmpty():
            return whole
        parts = 1 << STEP
        below = crowded.withColumns({"_level": c("_level") - STEP, "_cx": c("_cx") * parts, "_cy": c("_cy") * parts})
        for axis in ("_cx", "_cy"):
            below = below.withColumn(axis, F.explode(F.sequence(c(axis), c(axis) + parts - 1)))
        coarse = staged(_classified(below), "cells")
        whole = whole.union(coarse.where(c("_crossing") <= MOST_EDGES))
    return whole.union(coarse.where(c("_crossing") > MOST_EDGES))
