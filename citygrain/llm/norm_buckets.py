"""Ranked lexical search: impact vectors by length, pruned by bounds, rescored in integers.

A document is a vector with one coordinate per term that some item has: the term's weight times its
impact in the document. An item is a vector of ones at its terms, so a score is a dot product. The
vectors are ordered by length and cut into buckets of similar length. Once an item has its wanted
number of documents, the lowest of their scores is its threshold:

* a bucket whose greatest length, times the item's, is below the threshold holds nothing for it
  (Cauchy-Schwarz); where that is so for all items, the scan doesn't read the bucket;
* inside a bucket, the coordinates at the item's rarest terms are added up exactly; the rest of the product is
  at most the product of the lengths of both rests, and at most the sum of the bucket's greatest coordinates
  at the other terms; documents whose bound is below the threshold are dropped;
* what is left is scored exactly, in 64-bit integers.

The longest buckets are searched first, all over the cluster, for the thresholds that the other buckets
begin with. Bounds are taken slightly too high, so rounding never drops a document.

Terms are runs of letters and digits, and of characters beyond ASCII, compared by a 64-bit hash; A-Z are
lower-cased. Defined results: a null or empty text has no terms; a document without terms counts
nowhere; an item without terms, or whose terms no document has, has no rows; rows of one item id are one
item with the terms of them all, a null id being an id too; repeated documents are ranked each; equal
scores go by ascending id, null ids last; whole texts count, however long; empty tables give no rows.
Further columns don't matter, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citygrain.llm.words import slices, text_bytes, word_hashes
from citygrain.session import staged

BEST = 10

#: Items whose vectors are in memory together; more are searched in blocks.
BLOCK_ITEMS, BLOCK_TERMS = 2048, 1 << 20
#: The longest buckets with at least this many documents are searched first.
FIRST_DOCUMENTS = 8192
#: Buckets per doubling of the length, documents that are bounded together, rarest terms added up exactly.
BUCKETS, BOUNDED, FOCUS = 4, 512, 8

#: Bytes of terms, lower-cased; all others become blanks.
_TERM_BYTES = np.full(256, 0x20, dtype=np.uint8)
for _low, _high, _up in ((0x30, 0x39, 0), (0x41, 0x5A, 32), (0x61, 0x7A, 0), (0x80, 0xFF, 0)):
    _TERM_BYTES[_low : _high + 1] = np.arange(_low, _high + 1) + _up


def _terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of all terms, index of each row's first term) for runs of rows."""
    data, offsets = text_bytes(column)
    for low, high in slices(offsets):
        part = _TERM_BYTES[data[offsets[low] : offsets[high]]]
        yield low, *word_hashes(part, offsets[low : high + 1] - offsets[low])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of every item that has some, as hashes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, words, first in _terms(batch.column("text")):
                rows = low + np.repeat(np.arange(len(first) - 1), np.diff(first))
                yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(rows)), pa.array(words.view(np.int64))], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(hashed, f"item_id {kind}, term long").groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def term_vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, counts): all terms of a text, and how often it has each of the vocabulary's.

    ``vocabulary`` is a sorted array of hashes; ``terms`` are places in it.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, words, first in _terms(batch.column("text")):
                sizes = np.diff(first)
                place = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
                met = np.flatnonzero(vocabulary[place] == words)
                row = np.searchsorted(first, met, side="right") - 1
                keys, counts = np.unique(row * len(vocabulary) + place[met], return_counts=True)
                ends = np.searchsorted(keys // len(vocabulary), np.arange(len(sizes) + 1))
                some = np.flatnonzero(sizes)
                ends = np.concatenate([ends[some], ends[-1:]])  # rows without terms have no keys
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, len(sizes)).take(pa.array(some)),
                        pa.array(sizes[some].astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys % len(vocabulary), pa.int32())),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counts, pa.int32())),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(counted, "doc_id long, n long, terms array<int>, counts array<int>")


def _numbers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _begins(column: pa.Array) -> np.ndarray:
    offsets = column.offsets.to_numpy()
    return offsets.astype(np.int64) - offsets[0]


def impact_vectors(vectors: DataFrame, weights: np.ndarray, documents: int, length: int) -> DataFrame:
    """(doc_id, length, bucket, terms, impacts) of the documents that have some weight, longest first in a file."""

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, terms = _numbers(batch.column("counts")), _numbers(batch.column("terms"))
            begins = _begins(batch.column("terms"))
            rows = np.repeat(np.arange(batch.num_rows), np.diff(begins))
            damping = 10 + 90 * batch.column("n").to_numpy() * documents // length
            impacts = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * damping[rows]))
            lengths = np.sqrt(np.bincount(rows, impacts.astype(np.float64) ** 2, minlength=batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths),
                    pa.array(np.floor(np.log2(np.maximum(lengths, 1)) * BUCKETS).astype(np.int32)),
                    batch.column("terms"),
                    pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(impacts)),
                ],
                ["doc_id", "length", "bucket", "terms", "impacts"],
            )

    rows = vectors.where(F.size("terms") > 0)
    rows = rows.mapInArrow(weighed, "doc_id long, length double, bucket int, terms array<int>, impacts array<long>")
    return rows.where("length > 0").sortWithinPartitions(F.col("length").desc())


class _Items:
    """The vectors of a block of items, by item and by term."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray) -> None:
        self.count, self.size = len(terms), len(weights)
        # Rarest terms first: these are added up exactly before anything is bounded.
        ranked = [own[np.argsort(-weights[own], kind="stable")] for own in terms]
        self.length = np.sqrt(np.array([len(own) for own in terms], dtype=np.float64))
        self.rest = np.sqrt(np.array([max(len(own) - FOCUS, 0) for own in terms], dtype=np.float64))
        self.all = self._by_term(ranked)
        self.focus = self._by_term([own[:FOCUS] for own in ranked])
        self.others = np.concatenate([own[FOCUS:] for own in ranked])
        self.owner = np.repeat(np.arange(len(terms)), [max(len(own) - FOCUS, 0) for own in terms])

    def _by_term(self, terms: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate(terms)
        item = np.repeat(np.arange(len(terms)), [len(own) for own in terms])
        order = np.argsort(flat, kind="stable")
        return np.searchsorted(flat[order], np.arange(self.size + 1)), item[order]

    @staticmethod
    def met(lists: tuple[np.ndarray, np.ndarray], terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(coordinate, item) for the coordinates, given by term, that an item has too."""
        begins, items = lists
        sizes = begins[terms + 1] - begins[terms]
        coordinate = np.repeat(np.arange(len(terms)), sizes)
        shift = np.repeat(begins[terms] - (np.cumsum(sizes) - sizes), sizes)
        return coordinate, items[shift + np.arange(len(coordinate))]


class _Search:
    """The best documents of every item among those seen so far."""

    def __init__(self, items: _Items, least: np.ndarray, best: int) -> None:
        self.items, self.best = items, best
        self.least = least.copy()  # an item's documents must reach this score
        self.found = np.zeros((0, 4), dtype=np.int64)  # item, -score, id is null, id
        self.scored = self.bounded = 0

    def add(self, doc_ids: np.ndarray, missing: np.ndarray, lengths: np.ndarray, begins: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        """A bucket of documents: no longer than those before it, if they come in order."""
        items, count = self.items, len(doc_ids)
        open_items = items.length * lengths.max(initial=0.0) * (1 + 1e-9) >= self.least
        if not open_items.any():
            return
        rows = np.repeat(np.arange(count), np.diff(begins))
        coordinate, item = items.met(items.focus, terms)
        cell = item * count + rows[coordinate]
        own = impacts[coordinate].astype(np.float64)
        shape = (items.count, count)
        exact = np.bincount(cell, own, minlength=items.count * count).reshape(shape)
        used = np.bincount(cell, own * own, minlength=items.count * count).reshape(shape)
        left = np.sqrt(np.maximum(lengths**2 * (1 + 1e-9) - used, 0.0))
        greatest = np.zeros(items.size, dtype=np.int64)
        np.maximum.at(greatest, terms, impacts)
        most = np.bincount(items.owner, greatest[items.others].astype(np.float64), minlength=items.count)
        bound = exact + np.minimum(items.rest[:, None] * left, most[:, None])
        likely = open_items[:, None] & (bound * (1 + 1e-9) + 1 >= self.least[:, None])
        self.bounded += int(open_items.sum()) * count
        self.scored += int(likely.sum())
        wanted = likely.any(axis=0)[rows]
        coordinate, item = items.met(items.all, terms[wanted])
        row = rows[wanted][coordinate]
        kept = likely[item, row]
        scores = np.zeros(items.count * count, dtype=np.int64)
        np.add.at(scores, item[kept] * count + row[kept], impacts[wanted][coordinate[kept]])
        item, row = np.nonzero((scores.reshape(shape) >= self.least[:, None]) & likely)
        fresh = np.stack([item, -scores[item * count + row], missing[row], doc_ids[row]], axis=1)
        self._keep(np.concatenate([self.found, fresh]))

    def _keep(self, found: np.ndarray) -> None:
        found = found[np.lexsort(found.T[::-1])]
        begins = np.searchsorted(found[:, 0], np.arange(self.items.count + 1))
        rank = np.arange(len(found)) - begins[found[:, 0]]
        self.found = found[rank < self.best]
        full = np.flatnonzero(np.diff(begins) >= self.best)
        self.least[full] = np.maximum(self.least[full], -found[begins[full] + self.best - 1, 1])


def _candidates(vectors: DataFrame, items: _Items, least: np.ndarray, best: int) -> DataFrame:
    """(item, doc_id, score): every task's best documents of every item, none below its threshold."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(items, least, best)
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = batch.column("length").to_numpy()
            terms, impacts = _numbers(batch.column("terms")), _numbers(batch.column("impacts"))
            begins = _begins(batch.column("terms"))
            missing = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            doc_ids = batch.column("doc_id").fill_null(0).to_numpy()
            for low in range(0, batch.num_rows, BOUNDED):
                high = min(low + BOUNDED, batch.num_rows)
                own = slice(begins[low], begins[high])
                search.add(doc_ids[low:high], missing[low:high], lengths[low:high], begins[low : high + 1] - begins[low], terms[own], impacts[own])
        found = search.found
        ids = pa.array(found[:, 3], pa.int64(), mask=found[:, 2].astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), ids, pa.array(-found[:, 1])], ["item", "doc_id", "score"])

    return vectors.mapInArrow(searched, "item long, doc_id long, score long")


def _ranked(candidates: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _searched_block(docs: DataFrame, block: list, best: int) -> DataFrame:
    """The best documents of a block of items: (item, rank, doc_id, score), ``item`` being its place in the block."""
    hashes = [np.array(row["terms"], dtype=np.int64).view(np.uint64) for row in block]
    vocabulary = np.unique(np.concatenate(hashes))
    vectors = staged(term_vectors(docs, vocabulary), "terms")
    totals = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    documents, length = totals["documents"], totals["length"] or 1
    holding = np.zeros(len(vocabulary), dtype=np.int64)
    # One row per term of the block's items.
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in holding.tolist()], dtype=np.int64)
    items = _Items([np.searchsorted(vocabulary, own) for own in hashes], weights)
    impacts = staged(impact_vectors(vectors, weights, documents, length), "impacts")

    sizes = sorted(((row["bucket"], row["count"]) for row in impacts.groupBy("bucket").count().collect()), reverse=True)
    counted, first = 0, 0
    for first, size in sizes:
        counted += size
        if counted >= FIRST_DOCUMENTS:
            break
    least = np.ones(items.count, dtype=np.int64)
    longest = staged(_ranked(_candidates(impacts.where(F.col("bucket") >= first), items, least, best), best), "longest")
    for row in longest.where(F.col("rank") == best).select("item", "score").collect():  # one row per item
        least[row["item"]] = row["score"]
    # No item can have a document shorter than this; the scan skips such stretches of its files.
    shortest = float((least / items.length).min()) * (1 - 1e-9)
    rest = impacts.where((F.col("bucket") < first) & (F.col("length") >= shortest))
    return _ranked(longest.drop("rank").union(_candidates(rest, items, least, best)), best)


def ranked_documents(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of every item."""
    spark = docs.sparkSession
    known = staged(item_terms(items), "items")
    size = known.agg(F.count(F.lit(1)).alias("items"), F.sum(F.size("terms")).alias("terms")).first()
    kind = known.schema["item_id"].dataType
    blocks = max(math.ceil(size["items"] / BLOCK_ITEMS), math.ceil((size["terms"] or 0) / BLOCK_TERMS))
    results = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    for number in range(blocks):
        block = known.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()
        if not block:
            continue
        names = spark.createDataFrame([(place, row["item_id"]) for place, row in enumerate(block)], f"item long, item_id {kind.simpleString()}")
        found = _searched_block(docs, block, best).join(F.broadcast(names), "item")
        results = results.union(found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return results
