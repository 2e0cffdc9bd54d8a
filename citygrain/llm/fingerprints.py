"""Document fingerprints: MinHash signatures over five-word shingles, band join and verification.

Signatures come from many universal hash permutations in numpy. A fingerprint is the signature cut
to 16 bits per permutation, as hexadecimal text; the share of equal places estimates the Jaccard
similarity of two shingle sets.

Defined results: a null text is an empty one; empty texts have one common fingerprint, likeness 1
among themselves and (but for chance 2^-16 a place) 0 to others; a text of fewer than five words is
one shingle; rows with a null id come first; of rows with one id the smaller text comes first; a
single row is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.llm import lsh_forest
from citygrain.llm.columns import text_volume
from citygrain.llm.words import MinHash, lowered, shingle_hashes, slices, text_bytes, word_hashes
from citygrain.session import staged

PERMUTATIONS = 128
BANDS = 32

#: Bytes of input files that go to one range of ids.
RANGE_BYTES = 16 * 1024 * 1024
#: Split points that the driver holds at most; beyond them ranges grow, which are sorted and read as streams.
MOST_RANGES = 100_000


def sketches(column: pa.Array, hasher: MinHash) -> np.ndarray:
    """One row of 16-bit places for every text of an Arrow column."""
    data, offsets = text_bytes(column)
    out = np.zeros((len(offsets) - 1, len(hasher.factor)), dtype=np.uint16)
    for low, high in slices(offsets):
        words, first = word_hashes(lowered(data[offsets[low] : offsets[high]]), offsets[low : high + 1] - offsets[low])
        shingles, begins = shingle_hashes(words, first)
        for text in range(high - low):
            out[low + text] = _places(hasher.signature(shingles[begins[text] : begins[text + 1]]))
    return out


def _places(minima: np.ndarray) -> np.ndarray:
    return ((minima * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _hex(rows: np.ndarray) -> pa.Array:
    return pa.array([row.astype(">u2").tobytes().hex() for row in rows], pa.string())


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every whole text."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(PERMUTATIONS)
        for batch in batches:
            rows = sketches(batch.column("text"), hasher)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _hex(rows)], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(made, "doc_id long, fingerprint string")


def banded_nodes(docs: DataFrame) -> DataFrame:
    """(doc_id, node, prefixes, sketch): digest of the shingle set, value of every band and short sketch of every text."""

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(PERMUTATIONS)
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, signatures = [], []
            for _, node, own in lsh_forest.nodes_of(batch.column("text")):
                nodes.append(node)
                signatures.append(_places(hasher.signature(own)))
            rows = np.stack(signatures)
            bands = rows.view(np.int64)  # four places of 16 bits each
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(nodes) + 1) * BANDS, pa.int32()), pa.array(bands.ravel()))
            short = [row.tobytes() for row in rows.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(nodes, pa.binary()), lists, pa.array(short, pa.binary())],
                ["doc_id", "node", "prefixes", "sketch"],
            )

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(banded, "doc_id long, node binary, prefixes array<long>, sketch binary")


def verified_links(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs`` that has a link: doc_id, leader_id, jaccard, class_id and n_links.

    Texts that agree in one of the 32 bands of their signatures are compared, all with all and in
    blocks, and verified with the exact Jaccard similarity of the two shingle sets; two texts at 0.8
    agree in no band once in 10^7 pairs. n_links is the number of other rows at ``threshold`` or more, a
    class joins everything that such links connect and is named by its smallest id. leader_id is the
    smallest id that the row is linked to, and jaccard the similarity to it; the other links are not
    written, since a large group has too many. Texts of one shingle set are compared once.
    """
    signed = staged(banded_nodes(docs), "bands")
    facts = lsh_forest.linked_nodes(docs, signed, threshold).where("n_links > 0")
    rows = signed.select("doc_id", "node")
    own = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"))
    least = rows.groupBy("node").agg(F.min(own).alias("_first"), F.count(F.lit(1)).alias("_n"))
    # The second row of a node: the first id again if it is repeated, else the smallest but it.
    rest = rows.join(least, "node").select("node", "_first", own.alias("own"))
    rest = rest.groupBy("node").agg(
        F.count(F.when(F.col("own") == F.col("_first"), 1)).alias("_firsts"), F.min(F.when(F.col("own") != F.col("_first"), F.col("own"))).alias("_second")
    )
    least = least.join(rest, "node")
    alone = (own == F.col("_first")) & (F.col("_firsts") == 1)
    copy = F.when(~alone, F.col("_first")).otherwise(F.col("_second"))
    copy = F.when(copy.isNotNull(), F.struct(copy.missing.alias("missing"), copy.id.alias("id"), F.lit(1.0).alias("jaccard")))
    near = F.least(F.col("near"), copy)
    return (
        rows.join(facts, "node")
        .join(least, "node")
        .select("doc_id", near.id.alias("leader_id"), near.jaccard.alias("jaccard"), "class_id", "n_links")
    )


def _ranges(docs: DataFrame) -> tuple[list[int], list[int | None]]:
    """Split points of the ids, one per RANGE_BYTES of input, and the first id of each range."""
    count = max(docs.sparkSession.sparkContext.defaultParallelism, min(MOST_RANGES, text_volume(docs) // RANGE_BYTES))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"))
    points = sorted({int(p) for p in ids.approxQuantile("id", [i / count for i in range(1, count)], 0.2 / count)}) if count > 1 else []
    numbered = ids.mapInArrow(
        lambda batches: (
            pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.searchsorted(points, batch.column(0).to_numpy(), side="right"))], ["id", "range"])
            for batch in batches
        ),
        "id long, range long",
    )
    firsts = {row["range"]: row["first"] for row in numbered.groupBy("range").agg(F.min("id").alias("first")).collect()}
    return points, [firsts.get(i) for i in range(len(points) + 1)]


def in_order(docs: DataFrame) -> DataFrame:
    """(_range, _guest, doc_id, text) in ascending order of ids within ranges of ids.

    Every text is shuffled once. The first document of a range also goes to the end of the range
    before it (of the first range, to the end of the last) as a guest, so that each document meets
    its next one without any exchange between tasks.
    """
    points, firsts = _ranges(docs)
    filled = [i for i, first in enumerate(firsts) if first is not None]
    before = {now: filled[place - 1] for place, now in enumerate(filled)}
    starts = np.array([firsts[i] if firsts[i] is not None else 0 for i in range(len(firsts))], dtype=np.int64)
    previous = np.array([before.get(i, 0) for i in range(len(firsts))], dtype=np.int64)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("_key").to_numpy()
            place = np.searchsorted(points, key, side="right")
            own = [pa.array(place), pa.array(np.zeros(len(key), dtype=np.int8)), *batch.columns]
            names = ["_range", "_guest", *batch.schema.names]
            yield pa.RecordBatch.from_arrays(own, names)
            guests = np.flatnonzero(key == starts[place])
            if len(guests):
                rows = batch.take(pa.array(guests))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(previous[place[guests]]), pa.array(np.ones(len(guests), dtype=np.int8)), *rows.columns], names
                )

    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("_key"),
    )
    spread = keyed.mapInArrow(placed, "_range long, _guest byte, doc_id long, text string, _key long")
    parts = len(firsts)
    return (
        spread.repartitionById(parts, F.col("_range").cast("int"))
        .sortWithinPartitions("_range", "_guest", "_key", "text")
        .select("_range", "_guest", "doc_id", "text")
    )


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last floor(n/2) code points replaced by the first as many, or all, of
    the next document by ascending id; after the last document comes the first.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(PERMUTATIONS)
        held: tuple | None = None  # the last document of the rows so far: range, id, text, sketch
        for batch in batches:
            if not batch.num_rows:
                continue
            own = sketches(batch.column("text"), hasher)
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            places, guests = batch.column("_range").to_pylist(), batch.column("_guest").to_pylist()
            pairs = []  # (id, text, sketch, next text, next sketch)
            for row, text in enumerate(texts):
                if held is not None and held[0] == places[row]:
                    pairs.append((*held[1:], text, own[row]))
                held = (places[row], ids[row], text, own[row]) if not guests[row] else None
            if not pairs:
                continue
            edited = [text[: len(text) - len(text) // 2] + following[: len(text) // 2] for _, text, _, following, _ in pairs]
            mine = np.stack([pair[2] for pair in pairs])
            after = np.stack([pair[4] for pair in pairs])
            changed = sketches(pa.array(edited, pa.large_string()), hasher)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([pair[0] for pair in pairs], pa.int64()),
                    pa.array([len(pair[1]) for pair in pairs], pa.int64()),
                    pa.array([hashlib.sha256(text.encode()).hexdigest() for text in edited], pa.string()),
                    _hex(mine),
                    _hex(changed),
                    pa.array((mine == changed).mean(axis=1)),
                    pa.array((mine == after).mean(axis=1)),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return in_order(docs).mapInArrow(
        compared,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
