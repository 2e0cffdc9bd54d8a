"""Exact dedup with composable polynomial fingerprints and chunkwise comparison.

A text, lower-cased in A-Z only, is cut into chunks. Each chunk is hashed as a polynomial modulo
two primes; hash(a + b) = hash(a) + base^len(a) * hash(b), so chunks may be hashed anywhere and
combined in order. Texts with equal fingerprints and lengths are then compared chunk by chunk with
the one that stays; what differs although its fingerprint is equal forms a group of its own.

Defined results: a null text is an empty one, and empty texts are copies of each other; the row
with the largest id stays, a null id counts as the smallest; of rows that repeat id and text one
stays; an empty table gives an empty result; further columns don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.llm.columns import plain_names
from citygrain.llm.words import lowered, text_bytes
from citygrain.session import staged

CHUNK_BYTES = 1 << 16

#: Rows of a group that are compared with one copy of the text that stays.
ROWS_PER_COPY = 1000

#: Rows of the member list that are broadcast at most, 100 bytes each: 20 MB.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Polynomial:
    """Two moduli and bases; the moduli stay below 2^31, so products fit 64 bits."""

    moduli: tuple[int, int] = (2147483647, 2147483629)
    bases: tuple[int, int] = (1300391819, 1934612591)

    def powers(self) -> list[np.ndarray]:
        out = []
        for modulus, base in zip(self.moduli, self.bases, strict=True):
            table, have = np.ones(CHUNK_BYTES + 1, dtype=np.uint64), 1
            while have < len(table):
                take = min(have, len(table) - have)
                table[have : have + take] = table[:take] * np.uint64(pow(base, have, modulus)) % np.uint64(modulus)
                have += take
            out.append(table)
        return out

    def chunk(self, data: np.ndarray, powers: list[np.ndarray]) -> tuple[int, int]:
        """Hash of one chunk."""
        values = data.astype(np.uint64) + np.uint64(1)
        return tuple(int(np.dot(values, table[: len(values)])) % m for table, m in zip(powers, self.moduli, strict=True))

    def shift(self, length: int) -> tuple[int, int]:
        """What the hash of a text is multiplied with when ``length`` bytes come before it."""
        return tuple(pow(base, length, m) for base, m in zip(self.bases, self.moduli, strict=True))

    def joined(self, left: tuple[int, int], length: int, right: tuple[int, int]) -> tuple[int, int]:
        """Hash of left + right, where left has ``length`` bytes."""
        return tuple((a + s * b) % m for a, s, b, m in zip(left, self.shift(length), right, self.moduli, strict=True))

    def text(self, data: np.ndarray, powers: list[np.ndarray]) -> int:
        """Fingerprint of a whole text, both hashes in one number of 62 bits."""
        whole = (0, 0)
        for low in range(0, len(data), CHUNK_BYTES):
            whole = self.joined(whole, low, self.chunk(data[low : low + CHUNK_BYTES], powers))
        return whole[0] << 31 | whole[1]


def fingerprint_chunks(chunks: DataFrame, polynomial: Polynomial = Polynomial()) -> DataFrame:
    """Fingerprint of documents that come as rows (doc_id, seq, chunk) of normalised bytes.

    Chunks, of at most CHUNK_BYTES each, are hashed wherever they lie; only their hashes, lengths
    and shifts are shuffled, and combined in order of ``seq``.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = polynomial.powers()
        for batch in batches:
            texts = [np.frombuffer(value or b"", dtype=np.uint8) for value in batch.column("chunk").to_pylist()]
            hashes = [polynomial.chunk(text, powers) for text in texts]
            shifts = [polynomial.shift(len(text)) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("seq"), pa.array([len(text) for text in texts], pa.int64())]
                + [pa.array([pair[i] for pair in pairs], pa.int64()) for pairs in (hashes, shifts) for i in (0, 1)],
                ["doc_id", "seq", "size", "h0", "h1", "s0", "s1"],
            )

    rows = chunks.select("doc_id", "seq", "chunk").mapInArrow(
        hashed, "doc_id long, seq long, size long, h0 long, h1 long, s0 long, s1 long"
    )
    listed = rows.groupBy("doc_id").agg(
        F.sum("size").alias("n_bytes"), F.array_sort(F.collect_list(F.struct("seq", "h0", "h1", "s0", "s1"))).alias("parts")
    )
    one, two = polynomial.moduli
    start = F.struct(*(F.lit(value).cast("long").alias(name) for value, name in ((0, "h0"), (0, "h1"), (1, "s0"), (1, "s1"))))
    folded = F.aggregate(
        "parts",
        start,
        lambda left, right: F.struct(
            ((left.h0 + left.s0 * right.h0 % one) % one).alias("h0"),
            ((left.h1 + left.s1 * right.h1 % two) % two).alias("h1"),
            (left.s0 * right.s0 % one).alias("s0"),
            (left.s1 * right.s1 % two).alias("s1"),
        ),
        lambda left: F.shiftleft(left.h0, 31).bitwiseOR(left.h1),
    )
    return listed.select("doc_id", "n_bytes", folded.alias("fingerprint"))


def with_fingerprints(docs: DataFrame, polynomial: Polynomial = Polynomial()) -> DataFrame:
    """All columns, and ``_fingerprint``, ``_n_bytes`` and ``_sha256`` of the normalised text."""
    place = docs.columns.index("text")
    schema = docs.select("*").schema.add("_fingerprint", "long").add("_n_bytes", "long").add("_sha256", "string")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = polynomial.powers()
        for batch in batches:
            data, offsets = text_bytes(batch.column(place))
            prints, hashes = [], []
            for low, high in zip(offsets[:-1], offsets[1:], strict=True):
                text = lowered(data[low:high])
                prints.append(polynomial.text(text, powers))
                hashes.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(prints, pa.int64()), pa.array(np.diff(offsets)), pa.array(hashes, pa.string())],
                names=schema.names,
            )

    return docs.mapInArrow(marked, schema)


def _chunk_rows(docs: DataFrame, polynomial: Polynomial) -> DataFrame:
    """Normalised chunks of the texts whose fingerprint is the one they are listed with."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = polynomial.powers()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            listed = batch.column("_fingerprint").to_pylist()
            for row in range(batch.num_rows):
                text = lowered(data[offsets[row] : offsets[row + 1]])
                if polynomial.text(text, powers) != listed[row]:
                    continue  # another text under a repeated id
                sha = hashlib.sha256(text).hexdigest()
                chunks = [text[low : low + CHUNK_BYTES].tobytes() for low in range(0, max(1, len(text)), CHUNK_BYTES)]
                for low in range(0, len(chunks), 256):
                    part = chunks[low : low + 256]
                    own = pa.record_batch(batch.slice(row, 1)).take(pa.array([0] * len(part)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(own.column(name) for name in ("doc_id", "_fingerprint", "_n_bytes", "_round", "_size")),
                            pa.array([sha] * len(part)),
                            pa.array(range(low, low + len(part)), pa.int64()),
                            pa.array(part, pa.binary()),
                            pa.array([sha == own.column("_keep_sha")[0].as_py() and own.column("doc_id")[0] == own.column("_keep")[0]] * len(part)),
                        ],
                        ["doc_id", "_fingerprint", "_n_bytes", "_round", "_size", "_sha256", "_seq", "_chunk", "_stays"],
                    )

    return docs.select("doc_id", "_fingerprint", "_n_bytes", "_round", "_size", "_keep", "_keep_sha", "text").mapInArrow(
        cut,
        "doc_id long, _fingerprint long, _n_bytes long, _round long, _size long, _sha256 string, _seq long, _chunk binary,"
        " _stays boolean",
    )


GROUP = ["_fingerprint", "_n_bytes", "_round"]
ROW = ["doc_id", "_fingerprint", "_n_bytes", "_sha256"]


def exact_groups(docs: DataFrame, polynomial: Polynomial = Polynomial()) -> DataFrame:
    """One row per (id, text) of ``docs``: group key, ``_rows`` it stands for, ``_keep`` id and ``_size`` of its group.

    Groups are those of equal fingerprints; the comparison of chunks splits what doesn't belong
    together, round by round, until nothing differs.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = staged(
        with_fingerprints(texts, polynomial)
        .groupBy(*ROW)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_round", F.lit(0).cast("long")),
        "fingerprints",
    )
    last = 0
    while True:
        groups = rows.groupBy(*GROUP).agg(
            F.sum("_rows").alias("_size"),
            F.count(F.lit(1)).alias("_texts"),
            F.max(F.struct("doc_id", "_sha256")).alias("_top"),
        )
        groups = staged(
            groups.select(*GROUP, "_size", "_texts", F.col("_top.doc_id").alias("_keep"), F.col("_top._sha256").alias("_keep_sha")),
            "copies",
        )
        result = rows.join(_sized(groups.where("_size > 1")), GROUP, "left").select(
            *rows.columns,
            F.coalesce("_size", F.lit(1)).alias("_size"),
            F.when(F.col("_size").isNull(), F.col("doc_id")).otherwise(F.col("_keep")).alias("_keep"),
            F.coalesce("_keep_sha", "_sha256").alias("_keep_sha"),
        )
        compared = groups.where((F.col("_texts") > 1) & (F.col("_round") == last))
        members = rows.join(_sized(compared), GROUP)
        members = staged(members.select("doc_id", *GROUP, "_size", "_keep", "_keep_sha").distinct(), "members")
        differing = staged(_differing(texts, members, polynomial), "differing")
        if differing.isEmpty():
            return result
        last += 1
        moved = differing.select(*ROW, F.lit(last).cast("long").alias("_moved"))
        rows = staged(
            rows.join(moved, [rows[name].eqNullSafe(moved[name]) for name in ROW], "left").select(
                *(rows[name] for name in [*ROW, "_rows"]), F.coalesce(moved["_moved"], rows["_round"]).alias("_round")
            ),
            "regrouped",
        )


def _sized(frame: DataFrame) -> DataFrame:
    """Broadcast a small list after counting it; a longer one is left to a shuffled join."""
    return F.broadcast(frame) if frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else frame


def _differing(texts: DataFrame, members: DataFrame, polynomial: Polynomial) -> DataFrame:
    """Members whose chunks are not those of the text that stays in their group.

    The chunks of that text are copied for every ROWS_PER_COPY members, so that no key is hot.
    """
    listed = _sized(members).withColumnRenamed("doc_id", "_listed")
    chunks = _chunk_rows(texts.join(listed, texts["doc_id"].eqNullSafe(F.col("_listed"))).drop("_listed"), polynomial)
    copies = F.ceil(F.col("_size") / ROWS_PER_COPY).cast("int")
    staying = (
        chunks.where("_stays")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
        .select(*GROUP, "_seq", "_salt", F.col("_chunk").alias("_other"))
    )
    others = chunks.where(~F.col("_stays")).withColumn("_salt", F.pmod(F.hash("doc_id", "_sha256"), copies))
    return (
        others.join(staying, [*GROUP, "_seq", "_salt"], "left")
        .where(F.col("_other").isNull() | (F.col("_other") != F.col("_chunk")))
        .select(*ROW)
        .distinct()
    )


def mark_exact_duplicates(docs: DataFrame, polynomial: Polynomial = Polynomial()) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept and the hash of its text."""
    groups = exact_groups(docs, polynomial)
    return groups.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_rows"))).select(
        "doc_id",
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("_keep")) & (F.col("_sha256") == F.col("_keep_sha")) & (F.col("_copy") == 1)).alias("kept"),
        F.col("_sha256").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, polynomial: Polynomial = Polynomial()) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs, restored = plain_names(docs, ("doc_id", "text"))
    groups = exact_groups(docs, polynomial)
    gone = groups.where(~(F.col("doc_id").eqNullSafe(F.col("_keep")) & (F.col("_sha256") == F.col("_keep_sha"))))
    repeated = groups.where((F.col("_rows") > 1) & F.col("doc_id").eqNullSafe(F.col("_keep")) & (F.col("_sha256") == F.col("_keep_sha")))
    marked = with_fingerprints(docs, polynomial)

    def meets(frame: DataFrame, how: str) -> DataFrame:
        other = _sized(frame.select(*(F.col(name).alias(f"_{name}_other") for name in ROW)))
        return marked.join(other, [marked[name].eqNullSafe(F.col(f"_{name}_other")) for name in ROW], how)

    if repeated.isEmpty():
        return restored(meets(gone, "left_anti"))
    once = meets(repeated, "left_semi").dropDuplicates(ROW)
    return restored(meets(gone.select(*ROW).union(repeated.select(*ROW)), "left_anti").union(once))
