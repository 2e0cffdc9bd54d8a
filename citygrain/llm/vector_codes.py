"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

Vectors become integers and are cut into equal parts. Every part position has a codebook of a few
entries, fitted by rounds of assigning and averaging in whole numbers, so that any split of the table
gives the same codebooks. The nearest entry of a part is found by Orchard's search: each entry has
a list of the other entries by distance from it; the search walks the list of the best entry so far,
jumps to the list of a better one as soon as it meets it, marks what it has visited, and stops where the
next entry lies beyond twice the best distance, since no entry from there on can be nearer.

Defined results: rows whose vector is null or empty, or holds a null or a component that isn't finite,
are dropped; so are rows of another length than the row with the smallest id. A length that the number of
parts doesn't divide is filled with zeros at the end. Integers stop at +-2^26. Null ids come last and are
otherwise ids like any other; repeated rows count each; fewer rows than entries give fewer entries, and an
empty table gives no rows. Further columns don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.session import staged

#: Product code: parts of a vector, entries of a codebook, rounds of fitting, steps of one unit.
PARTS, ENTRIES, ROUNDS, UNIT = 8, 16, 6, 4096

#: Integers stop here, so that squared distances and their sums over a vector fit 64 bits.
MOST = 1 << 26


class Orchard:
    """Nearest entry of a small codebook, with distance-sorted neighbour lists."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries.astype(np.int64)
        apart = self.entries[:, None, :] - self.entries[None, :, :]
        between = (apart * apart).sum(axis=2)
        others = np.argsort(between, axis=1, kind="stable")
        itself = np.arange(len(entries))[:, None]
        self.lists = others[others != itself].reshape(len(entries), max(len(entries) - 1, 0))
        self.between = np.take_along_axis(between, self.lists, axis=1)
        # A search begins at an entry whose components have about the same sum.
        self._by_sum = np.argsort(self.entries.sum(axis=1), kind="stable")
        self._sums = self.entries.sum(axis=1)[self._by_sum]
        self.compared = 0

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every point, ties to the lower index, and its squared distance."""
        begin = np.minimum(np.searchsorted(self._sums, points.sum(axis=1)), len(self.entries) - 1)
        best = self._by_sum[begin]
        nearest = self._squared(points, best)
        visited = np.zeros((len(points), len(self.entries)), dtype=bool)
        visited[np.arange(len(points)), best] = True
        place = np.zeros(len(points), dtype=np.int64)
        walking = np.arange(len(points)) if len(self.entries) > 1 else np.zeros(0, dtype=np.int64)
        while len(walking):
            own, at = best[walking], place[walking]
            # An entry beyond twice the distance is farther away than the best one; an equal one is not beyond.
            walking = walking[self.between[own, at] <= 4 * nearest[walking]]
            met = self.lists[best[walking], place[walking]]
            place[walking] += 1
            fresh = ~visited[walking, met]
            rows, met = walking[fresh], met[fresh]
            visited[rows, met] = True
            distance = self._squared(points[rows], met)
            better = (distance < nearest[rows]) | ((distance == nearest[rows]) & (met < best[rows]))
            rows = rows[better]
            best[rows], nearest[rows], place[rows] = met[better], distance[better], 0
            walking = walking[place[walking] < self.lists.shape[1]]
        return best, nearest

    def _squared(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        self.compared += len(points)
        apart = points - self.entries[entries]
        return (apart * apart).sum(axis=1)


@dataclass
class Codebooks:
    """Entries by part, entry and position within a part; the rows carry them as one hash."""

    entries: np.ndarray

    def indexes(self) -> list[Orchard]:
        return [Orchard(part) for part in self.entries]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integer_vectors(vectors: DataFrame, unit: int = UNIT) -> DataFrame:
    """(vec_id, label, whole) of the rows whose vector is whole; ``whole`` is floor(unit * component)."""

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding").cast(pa.large_list(pa.float64()))
            lengths = np.diff(column.offsets.to_numpy())
            lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, lengths)
            numbers = column.flatten().to_numpy(zero_copy_only=False)  # nulls are not finite either
            broken = np.concatenate([[0], np.cumsum(~np.isfinite(numbers))])
            ends = np.cumsum(lengths)
            kept = (lengths > 0) & (broken[ends] == broken[ends - lengths])
            whole = np.clip(np.floor(np.where(np.isfinite(numbers), numbers, 0.0) * unit), -MOST, MOST).astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(lengths[kept])])
            lists = pa.LargeListArray.from_arrays(offsets, whole[np.repeat(kept, lengths)])
            rows = batch.filter(pa.array(kept))
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"), lists.cast(pa.list_(pa.int32()))], ["vec_id", "label", "whole"]
            )

    chosen = vectors.select("vec_id", "label", "embedding")
    kinds = {field.name: field.dataType.simpleString() for field in chosen.schema}
    return chosen.mapInArrow(scaled, f"vec_id {kinds['vec_id']}, label {kinds['label']}, whole array<int>")


def _parts(batch: pa.RecordBatch, parts: int, width: int) -> np.ndarray:
    """Integers of a batch as (row, part, position), filled with zeros at the end."""
    column = batch.column("whole")
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)
    filled = np.zeros((len(rows), parts * width), dtype=np.int64)
    filled[:, : rows.shape[1]] = rows
    return filled.reshape(len(rows), parts, width)


def fit_codebooks(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Codebooks | None, DataFrame]:
    """Codebooks after all rounds, and the rows of ``whole`` that have the right length.

    A round is one pass over all vectors; tasks add up the integers of each entry, and only these
    sums, whose number doesn't grow with the table, reach the driver.
    """
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(1).collect()
    if not first:
        return None, whole
    length = len(first[0]["whole"])
    whole = whole.where(F.size("whole") == length)
    start = whole.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(entries).select("whole").toArrow()
    width = -(-length // parts)
    books = Codebooks(_parts(start.combine_chunks().to_batches()[0], parts, width).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _averaged(whole, books)
    return books, whole


def _averaged(whole: DataFrame, books: Codebooks) -> Codebooks:
    """One round: parts go to their nearest entries, whose integers are averaged, rounding down."""
    parts, entries, width = books.entries.shape

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = books.indexes()
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        counts = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            points = _parts(batch, parts, width)
            for part, index in enumerate(indexes):
                nearest, _ = index.search(points[:, part])
                np.add.at(sums[part], nearest, points[:, part])
                counts[part] += np.bincount(nearest, minlength=entries)
        part, entry = np.nonzero(counts)
        position = np.tile(np.arange(width), len(part))
        part, entry = np.repeat(part, width), np.repeat(entry, width)
        columns = [part, entry, position, sums[part, entry, position], counts[part, entry]]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], ["part", "entry", "position", "total", "rows"])

    found = (
        whole.select("whole")
        .mapInArrow(added, "part long, entry long, position long, total long, rows long")
        .groupBy("part", "entry", "position")
        .agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
    )
    means = books.entries.copy()
    for row in found.collect():  # parts x entries x width rows
        means[row["part"], row["entry"], row["position"]] = row["total"] // row["rows"]
    return Codebooks(means)


def encode_vectors(whole: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): entry numbers in order of the parts, and the summed squared distances."""
    parts, _, width = books.entries.shape

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = books.indexes()
        for batch in batches:
            points = _parts(batch, parts, width)
            codes = np.zeros((len(points), parts), dtype=np.uint8)
            error = np.zeros(len(points), dtype=np.int64)
            for part, index in enumerate(indexes):
                codes[:, part], distance = index.search(points[:, part])
                error += distance
            text = pa.array([row.tobytes().hex() for row in codes], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), text, pa.array(error)], ["vec_id", "label", "code", "error"]
            )

    kinds = {field.name: field.dataType.simpleString() for field in whole.schema}
    return whole.mapInArrow(coded, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def decode_vectors(codes: DataFrame, books: Codebooks, unit: int = UNIT) -> DataFrame:
    """(vec_id, embedding): the vector that each code stands for, at the lower ends of its steps."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.arange(len(books.entries))
        for batch in batches:
            entry = np.array([list(bytes.fromhex(code)) for code in batch.column("code").to_pylist()], dtype=np.int64)
            values = books.entries[parts, entry.reshape(-1, len(parts))].reshape(len(entry), -1) / unit
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(list(values), pa.list_(pa.float64()))], ["vec_id", "embedding"])

    kind = codes.schema["vec_id"].dataType.simpleString()
    return codes.select("vec_id", "code").mapInArrow(read, f"vec_id {kind}, embedding array<double>")


def compress_vectors(vectors: DataFrame) -> DataFrame:
    """Codes of all whole vectors with the errors by label and the hash of the codebooks."""
    books, whole = fit_codebooks(staged(integer_vectors(vectors), "vectors"))
    books = books or Codebooks(np.zeros((PARTS, 0, 0), dtype=np.int64))
    codes = staged(encode_vectors(whole, books), "codes")
    # Few labels are broadcast by their written size; many are joined by hash, where a hot label is split.
    totals = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    totals = staged(totals.select(F.col("label").alias("_label"), F.least("label_error", F.lit(2**63 - 1)).cast("long").alias("label_error")), "labels")
    return codes.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
