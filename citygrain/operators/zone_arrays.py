"""A zone index as arrays that tasks search, for a whole batch of places at once.

An index that is small enough to broadcast is brought into flat arrays: per level the listed cells, per cell
its zones, per zone and cell its edges. Interpreted array functions took some hundred microseconds a point.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs of a place and a zone, or of a place and an edge, that are worked out at once.
MOST_PAIRS = 250_000

BOX = ("minx", "miny", "maxx", "maxy")
EDGE = ("x1", "y1", "x2", "y2")


def counted(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) for ``count`` numbers of every row, from its ``first`` on."""
    rows = np.repeat(np.arange(len(count)), count)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(count) - count - first, count)


def slices(count: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbouring rows whose counts make about ``most`` together, or single rows above it."""
    ends, low = np.cumsum(count), 0
    while low < len(count):
        begun = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, begun + most, side="right")))
        yield slice(low, high)
        low = high


@dataclass(frozen=True)
class Cells:
    """The listed cells of a level: numbers of columns and rows, and for each cell where its zones lie."""

    xs: np.ndarray
    ys: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    count: np.ndarray

    def find(self, cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first zone, number of zones) of each cell; its numbers are doubles, as they may be very large."""
        i = np.minimum(np.searchsorted(self.xs, cx), len(self.xs) - 1)
        j = np.minimum(np.searchsorted(self.ys, cy), len(self.ys) - 1)
        key = i * len(self.ys) + j
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        listed = (self.xs[i] == cx) & (self.ys[j] == cy) & (self.keys[place] == key)
        return self.first[place], np.where(listed, self.count[place], 0)


@dataclass(frozen=True)
class ZoneArrays:
    """``cells`` by level. The other arrays have a place for each zone of a cell, and ``edges`` for each edge of those."""

    cells: dict[int, Cells]
    ident: np.ndarray
    rank: np.ndarray  # of the zone's order; not a number where it has none
    alike: np.ndarray  # number of the zone's values
    inside: np.ndarray
    box: tuple[np.ndarray, ...]
    first: np.ndarray
    count: np.ndarray
    edges: tuple[np.ndarray, ...]

    def covers(self, zone: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether each point is on an edge of its zone, or has an odd number of them to its right."""
        found = np.zeros(len(zone), bool)
        for part in slices(self.count[zone], MOST_PAIRS):
            row, edge = counted(self.first[zone[part]], self.count[zone[part]])
            x1, y1, x2, y2 = (values[edge] for values in self.edges)
            px, py = x[part][row], y[part][row]
            side = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
            right = ((y1 > py) != (y2 > py)) & ((side > 0) == (y2 > y1))
            within = np.bincount(row[right], minlength=part.stop - part.start) % 2 == 1
            on = (side == 0) & (px >= np.minimum(x1, x2)) & (px <= np.maximum(x1, x2)) & (py >= np.minimum(y1, y2)) & (py <= np.maximum(y1, y2))
            within[row[on]] = True
            found[part] = within
        return found

    def first_zones(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The place of the first zone, by its order, that covers each point; -1 for none."""
        best, rank = np.full(len(x), -1), np.full(len(x), np.nan)
        for level in sorted(self.cells):
            first, count = self.cells[level].find(np.floor(x / 2.0**level), np.floor(y / 2.0**level))
            found = np.full(len(x), -1)
            for part in slices(count, MOST_PAIRS):
                row, zone = counted(first[part], count[part])
                row = row + part.start
                minx, miny, maxx, maxy = (values[zone] for values in self.box)
                hit = self.inside[zone].copy()
                tried = np.flatnonzero(~hit & (x[row] >= minx) & (x[row] <= maxx) & (y[row] >= miny) & (y[row] <= maxy))
                hit[tried] = self.covers(zone[tried], x[row[tried]], y[row[tried]])
                row, zone = row[hit], zone[hit]
                # Zones of a cell lie in their order.
                head = np.flatnonzero(np.diff(row, prepend=-1))
                found[row[head]] = zone[head]
            own = np.where(found >= 0, self.rank[found], np.nan)
            taken = (found >= 0) & ((best < 0) | (own < rank))
            best, rank = np.where(taken, found, best), np.where(taken, own, rank)
        return best


def zone_arrays(index: DataFrame, order: Sequence[str], alike: Sequence[str] = ()) -> ZoneArrays:
    """The arrays of an index with ``_id`` and ``_order``; zones of one cell come in the given order.

    Zones with the same ``_order`` and the same values of ``alike`` share a number. The index comes to the driver, as one that is broadcast does.
    """
    box = [F.col(f"_box.{name}").alias(f"_{name}") for name in BOX]
    rows = index.select("_id", "_order", "_level", F.col("_cx").cast("double"), F.col("_cy").cast("double"), "_inside", *box, "_edges", *alike, F.struct(*order).alias("_place"))
    table = rows.orderBy("_place").drop("_place").toArrow().combine_chunks()

    def column(name: str) -> pa.Array:
        values = table.column(name)
        return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values

    def numbers(name: str) -> np.ndarray:
        return column(name).to_numpy(zero_copy_only=False)

    level, cx, cy = numbers("_level"), numbers("_cx"), numbers("_cy")
    cells, places, done = {}, [], 0
    for own in np.unique(level):
        rows_of = np.flatnonzero(level == own)
        xs, i = np.unique(cx[rows_of], return_inverse=True)
        ys, j = np.unique(cy[rows_of], return_inverse=True)
        key = i * len(ys) + j
        sorted_rows = np.argsort(key, kind="stable")
        keys, first, count = np.unique(key[sorted_rows], return_index=True, return_counts=True)
        cells[int(own)] = Cells(xs, ys, keys, first + done, count)
        places.append(rows_of[sorted_rows])
        done += len(rows_of)
    at = np.concatenate(places) if places else np.zeros(0, np.int64)

    lists = column("_edges")
    count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    edges = tuple(np.asarray(flat.field(name).to_numpy(zero_copy_only=False), float) for name in EDGE)
    codes: dict[str, int] = {}
    told = zip(*(column(name).to_pylist() for name in ("_order", *alike)))
    same = np.array([codes.setdefault(repr(values), len(codes)) for values in told], np.int64)
    ranks = np.asarray(_ranks(column("_order")), float)
    return ZoneArrays(
        cells, numbers("_id")[at], ranks[at], same[at], numbers("_inside").astype(bool)[at],
        tuple(np.asarray(numbers(f"_{name}"), float)[at] for name in BOX), (np.cumsum(count) - count)[at], count[at], edges,
    )


def _ranks(order: pa.Array) -> np.ndarray:
    """Places of the values among the different ones; not a number for NULL."""
    codes = order.dictionary_encode()
    by_value = pc.sort_indices(codes.dictionary).to_numpy(zero_copy_only=False)
    rank = np.empty(len(by_value))
    rank[by_value] = np.arange(len(by_value))
    code = pc.fill_null(codes.indices, -1).to_numpy(zero_copy_only=False)
    return np.where(code >= 0, rank[code] if len(rank) else np.nan, np.nan)
