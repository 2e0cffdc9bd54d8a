"""Token ids in binary files: one zstandard dictionary, a frame per document, an index for single documents.

A file holds, in this order: the magic, a JSON header behind its length (id width, hash of the
dictionary, number of documents and ids), one compressed frame per document, and the index behind the
frames: the offset of every frame (one more than documents), the number of ids of every document, and the
document ids with a mark for null ones; the last eight bytes say where the index begins. All numbers are
little-endian. The dictionary is a file of its own, trained once on serialized id arrays, and a reader
refuses one whose hash isn't the header's.

Texts are encoded by the tokenizers library. A text is cut where a blank follows something that isn't
one, which is where its pattern always ends a token, and equal pieces are encoded once while they are remembered.

Defined results: a null or empty text has the end id alone; documents stand in ascending order of ids,
null ids first, and rows of one id by hash of their texts; repeated rows stand each for itself; an empty
table gives no files and no rows. Very long texts are cut into segments at the same places while they
are encoded. Further columns don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citygrain.llm import files
from citygrain.llm.columns import text_volume
from citygrain.session import staged

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
END_ID = 0

#: The dictionary is trained on this many documents at most, the first characters of each.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 2000, 16_384
DICTIONARY_BYTES = 64 << 10
LEVEL = 3

#: Input to a range of ids, ranges at most (a range has several files then), bytes of frames in a file.
RANGE_BYTES, MOST_RANGES, FILE_BYTES = 16 << 20, 10_000, 64 << 20
#: Files whose totals are added in one group of the prefix sums.
BLOCK = 1024

MAGIC = b"IDFRAME1"

#: White space of Unicode: what Python calls blank, without the four information separators.
_PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
_CUT = re.compile(r"[\S\x1c-\x1f](?=[^\S\x1c-\x1f])")
#: The pattern of byte-level vocabularies (a fixed value) within ASCII and the Latin letters behind it.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_LATIN = re.compile(f"[\\x00-\\x7f{_LETTERS}]+")
_LATIN_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+", re.ASCII)
_SEGMENT = 1 << 20
#: Pieces and tokens that a worker remembers, about 200 bytes each, and the longest of them.
_KEPT_PIECES, _KEPT_TOKENS, _KEPT_CHARS = 1_200_000, 600_000, 24


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: its own, or one from 256 on."""
    hidden = [byte for byte in range(256) if not (33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte)]
    return {byte: chr(256 + place) for place, byte in enumerate(hidden)}


class PieceEncoder:
    """Ids of texts as bytes, little-endian, ``width`` bytes each.

    Pieces are encoded once and remembered. Latin pieces of a byte-level vocabulary go straight to the
    library's merges; all others, and those with a special token, go through the whole library. A
    vocabulary with other rules has its texts encoded whole.
    """

    def __init__(self, path: str = TOKENIZER) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        split = rules["pre_tokenizer"] or {}
        self._by_piece = (split.get("type"), split.get("use_regex"), split.get("add_prefix_space"), rules["normalizer"]) == ("ByteLevel", True, False, None)
        self._tokenizer = Tokenizer.from_file(path)
        special = [re.escape(token.content) for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._has_special = re.compile("|".join(special) or "(?!)").search
        self.width = 2 if self._tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self._kind = "H" if self.width == 2 else "I"
        self._known = _Pieces(self.piece, _KEPT_PIECES)
        self._tokens = _Pieces(self.token, _KEPT_TOKENS)
        self._letters = _byte_letters()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, the same as the library's for it."""
        if not self._by_piece:
            return self._library(text)
        out, low = [], 0
        while low < len(text):
            cut = _CUT.search(text, low + _SEGMENT) if len(text) - low > _SEGMENT else None
            high = cut.end() if cut else len(text)
            out.append(b"".join(map(self._known.__getitem__, _PIECE.findall(text, low, high))))
            low = high
        return b"".join(out)

    def _library(self, text: str) -> bytes:
        return array(self._kind, self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of a piece that isn't remembered."""
        if not _LATIN.fullmatch(piece) or self._has_special(piece):
            return self._library(piece)
        return b"".join(map(self._tokens.__getitem__, _LATIN_TOKEN.findall(piece)))

    def token(self, token: str) -> bytes:
        """Ids of what the pattern takes as one."""
        letters = token.encode().decode("latin-1").translate(self._letters)
        return array(self._kind, [one.id for one in self._tokenizer.model.tokenize(letters)]).tobytes()


class _Pieces(dict):
    """Ids of at most so many pieces; a piece that isn't there is encoded."""

    def __init__(self, encode: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self._encode, self._most = encode, most

    def __missing__(self, piece: str) -> bytes:
        ids = self._encode(piece)
        if len(piece) <= _KEPT_CHARS:
            if len(self) >= self._most:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """The encoder of a worker process, whose pieces later tasks find again."""
    return PieceEncoder(path)


def _hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def _loaded(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def train_dictionary(docs: DataFrame, path: str = TOKENIZER, documents: int = SAMPLE_DOCUMENTS, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from the id arrays of ``documents`` texts, those of the smallest hashes.

    Only this bounded sample is brought to the driver. Texts too few to train on give their own ids
    as content, and no texts give no dictionary.
    """
    rows = docs.count()
    if not rows:
        return b""
    drawn = F.xxhash64(F.col("doc_id"), F.col("text"))
    share = min(1.0, 4 * documents / rows)
    sample = docs.select(drawn.alias("_drawn"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    if share < 1:
        sample = sample.where(F.col("_drawn") < int(-(2**63) + share * 2**64))
    sample = sample.where("length(text) > 0").orderBy("_drawn", "text").limit(documents)

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([encoder.encode(text) for text in batch.column("text").to_pylist()], pa.binary())], ["ids"])

    import zstandard

    arrays = [bytes(row["ids"]) for row in sample.select("text").mapInArrow(serialized, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, arrays).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(arrays)[:size]


class IdFileWriter:
    """Collects compressed documents and publishes them as files of about ``FILE_BYTES``."""

    def __init__(self, folder: str, range_no: int, dictionary: bytes, width: int) -> None:
        import zstandard

        self._folder, self._range, self._width, self._hash = folder, range_no, width, _hash(dictionary)
        self._compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_loaded(dictionary), write_content_size=True)
        self._number = 0
        self._empty()

    def _empty(self) -> None:
        self._frames: list[bytes] = []
        self._ids: list[int | None] = []
        self._tokens: list[int] = []
        self._bytes = 0

    def add(self, doc_id: int | None, ids: bytes) -> tuple | None:
        """Add a document; a manifest row if that filled a file."""
        frame = self._compressor.compress(ids)
        self._frames.append(frame)
        self._ids.append(doc_id)
        self._tokens.append(len(ids) // self._width)
        self._bytes += len(frame)
        return self.publish() if self._bytes >= FILE_BYTES else None

    def publish(self) -> tuple | None:
        """Write what is collected: a manifest row."""
        if not self._frames:
            return None
        total = sum(self._tokens)
        header = {"width": self._width, "dictionary": self._hash, "documents": len(self._ids), "ids": total}
        text = json.dumps(header).encode()
        head = MAGIC + np.array([len(text)], dtype="<u8").tobytes() + text
        offsets = len(head) + np.concatenate([[0], np.cumsum([len(frame) for frame in self._frames])])
        index = b"".join(
            [
                offsets.astype("<u8").tobytes(),
                np.array(self._tokens, dtype="<u8").tobytes(),
                np.array([doc_id or 0 for doc_id in self._ids], dtype="<i8").tobytes(),
                np.array([doc_id is None for doc_id in self._ids], dtype="u1").tobytes(),
            ]
        )
        name = f"{self._folder}/ids-{self._range:06d}-{self._number:04d}.idf"
        body = [head, *self._frames, index, offsets[-1:].astype("<u8").tobytes()]
        files.write_file(name, b"".join(body))
        row = (name, self._range, self._number, len(self._ids), total, sum(map(len, body)), self._ids[0], self._ids[-1])
        self._number += 1
        self._empty()
        return row


class IdFile:
    """A file's index, and its documents by range reads."""

    def __init__(self, uri: str, dictionary: bytes) -> None:
        import zstandard

        self._file = files.open_read(uri)
        end = self._file.seek(0, os.SEEK_END)
        if self._read(0, 8) != MAGIC:
            raise ValueError(f"not a file of ids: {uri}")
        size = int(np.frombuffer(self._read(8, 8), "<u8")[0])
        self.header = json.loads(self._read(16, size))
        if self.header["dictionary"] != _hash(dictionary):
            raise ValueError(f"the dictionary is not the one that {uri} was written with")
        self._kind = f"<u{self.header['width']}"
        at = int(np.frombuffer(self._read(end - 8, 8), "<u8")[0])
        index, count = self._read(at, end - 8 - at), self.header["documents"]
        self.offsets = np.frombuffer(index, "<u8", count + 1).astype(np.int64)
        self.tokens = np.frombuffer(index, "<u8", count, 8 * (count + 1)).astype(np.int64)
        numbers = np.frombuffer(index, "<i8", count, 8 * (2 * count + 1))
        missing = np.frombuffer(index, "u1", count, 8 * (3 * count + 1))
        self.doc_ids = [None if lost else number for number, lost in zip(numbers.tolist(), missing.tolist(), strict=True)]
        self._decompressor = zstandard.ZstdDecompressor(dict_data=_loaded(dictionary))

    def _read(self, at: int, size: int) -> bytes:
        self._file.seek(at)
        return self._file.read(size)

    def document(self, place: int) -> np.ndarray:
        """Ids of one document; nothing but its frame is read."""
        low, high = self.offsets[place : place + 2].tolist()
        return np.frombuffer(self._decompressor.decompress(self._read(low, high - low)), self._kind)

    def documents(self, read_bytes: int = 8 << 20) -> Iterator[np.ndarray]:
        """Ids of all documents in order, read a stretch of frames at a time."""
        low = 0
        while low < len(self.tokens):
            high = max(low + 1, int(np.searchsorted(self.offsets, self.offsets[low] + read_bytes, side="right")) - 1)
            stretch = memoryview(self._read(int(self.offsets[low]), int(self.offsets[high] - self.offsets[low])))
            for place in range(low, high):
                begin, end = (self.offsets[place : place + 2] - self.offsets[low]).tolist()
                yield np.frombuffer(self._decompressor.decompress(stretch[begin:end]), self._kind)
            low = high

    def close(self) -> None:
        self._file.close()

    def __enter__(self) -> IdFile:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


MANIFEST = "file string, range int, number int, documents long, ids long, bytes long, first_id long, last_id long"


def write_ids(docs: DataFrame, folder: str, path: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Encode all texts into files of ``folder`` in ascending order of ids; the manifest, one row per file.

    Texts are shuffled once, by ranges of (id, hash of the text), so that many rows of one id are
    several ranges, and encoded by the task that writes them. A task that runs again replaces its
    files by equal ones.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dictionary = train_dictionary(docs, path)
    files.write_file(f"{folder}/dictionary", dictionary)
    ranges = max(spark.sparkContext.defaultParallelism, min(MOST_RANGES, -(-text_volume(docs) // RANGE_BYTES)))
    ordered = (
        # Equal rows may stand in any order; a number splits them among ranges.
        docs.withColumns({"_hash": F.xxhash64("text"), "_place": F.monotonically_increasing_id()})
        .repartitionByRange(ranges, "doc_id", "_hash", "_place")
        .sortWithinPartitions("doc_id", "_hash", "text")
        .select(F.spark_partition_id().alias("range"), "doc_id", "text")
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, rows = piece_encoder(path), None, []
        end = np.array([end_id], dtype=f"<u{encoder.width}").tobytes()
        for batch in batches:
            if writer is None and batch.num_rows:
                writer = IdFileWriter(folder, batch.column("range")[0].as_py(), dictionary, encoder.width)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                rows.append(writer.add(doc_id, encoder.encode(text.as_py()) + end))
        rows.append(writer.publish() if writer else None)
        names = ["file", "range", "number", "documents", "ids", "bytes", "first_id", "last_id"]
        kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 5]
        columns = list(zip(*filter(None, rows), strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names)

    return staged(ordered.mapInArrow(written, MANIFEST), "manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the number of ids in all files before each; two levels of prefix sums."""
    placed = manifest.withColumn("_block", F.floor(F.col("range") / BLOCK))
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy(F.col("_block").alias("_of")).agg(F.sum("ids").alias("_ids"))  # MOST_RANGES / BLOCK rows
    blocks = blocks.select("_of", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_block").orderBy("range", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_inside", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
    joined = placed.join(F.broadcast(blocks), F.col("_block") == F.col("_of"))
    return joined.select(*manifest.columns, (F.col("_before") + F.col("_inside")).alias("start"))


def read_ids(manifest: DataFrame, folder: str, ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, its ids.

    Files are dealt out one by one; each is read once, frame by frame.
    """
    spark = manifest.sparkSession
    starts = staged(with_starts(manifest), "starts")
    parts = max(1, min(starts.count(), 4 * MOST_RANGES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with files.open_read(f"{folder}/dictionary") as file:
            dictionary = file.read()
        for batch in batches:
            for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with IdFile(uri, dictionary) as source:
                    begins = start + np.cumsum(source.tokens) - source.tokens
                    low, sums, lists, size = 0, [], [], 0
                    for place, own in enumerate(source.documents()):
                        wide = own.astype("<u4")
                        sums.append(zlib.crc32(wide.tobytes()))
                        if ids:
                            lists.append(wide.astype(np.int32))
                            size += wide.nbytes
                        high = place + 1
                        if high == len(source.tokens) or high - low == 10_000 or size > 4 << 20:
                            columns = [
                                pa.array(source.doc_ids[low:high], pa.int64()),
                                pa.array(begins[low:high]),
                                pa.array(source.tokens[low:high]),
                                pa.array(sums, pa.int64()),
                            ]
                            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                            if ids:
                                columns, names = [*columns, pa.array(lists, pa.list_(pa.int32()))], [*names, "ids"]
                            yield pa.RecordBatch.from_arrays(columns, names)
                            low, sums, lists, size = high, [], [], 0

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    place = F.pmod(F.col("range") + F.col("number") * 7919, F.lit(parts)).cast("int")
    spread = starts.repartitionById(parts, place).select("file", "start")
    return spread.mapInArrow(read, schema)


def read_document(spark: SparkSession, manifest: DataFrame, folder: str, doc_id: int) -> list[np.ndarray]:
    """Ids of the documents of one id: the manifest leaves few files, of which the index and single frames are read."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with files.open_read(f"{folder}/dictionary") as file:
            dictionary = file.read()
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                with IdFile(uri, dictionary) as source:
                    own = [source.document(i).astype(np.int32) for i, known in enumerate(source.doc_ids) if known == doc_id]
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32()))], ["ids"])

    near = manifest.where((F.col("last_id") >= doc_id) & F.coalesce(F.col("first_id") <= doc_id, F.lit(True)))
    rows = near.select("file").mapInArrow(found, "ids array<int>").collect()
    return [np.array(row["ids"], dtype=np.int64) for row in rows]
