"""WARC records in ZIP-packaged archives: written by tasks, located by directory, read by range.

An archive is a ZIP file with two stored (not compressed) members: the WARC records and an index of
(offset, length) per record. The reader parses the end record, the ZIP64 end record and the central
directory, finds stored members, and reads single records at their place in the archive, without
extracting anything.

Defined results: a null payload is an empty one; records with equal payloads below 100 bytes are all
responses; of larger equal ones the row with the smallest page_id is the response and the others
revisit it, while rows that repeat that id are responses too; a null page_id counts as the largest; null urls are empty
and line breaks in urls are written as blanks; an empty table gives no archive and no record;
further columns don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.llm import files
from citygrain.session import staged

#: Payloads of at least so many bytes may be revisited.
REVISIT_BYTES = 100

#: Date of records that no other is given for.
DATE = "1970-01-01T00:00:00Z"

#: Bytes of records after which a task begins another archive.
ARCHIVE_BYTES = 64 * 1024 * 1024

#: Records that one task reads in a go.
READ_RECORDS = 512

WARC_MEMBER, INDEX_MEMBER = "records.warc", "records.idx"

# Fixed values of the ZIP format: signatures and record layouts, little-endian.
LOCAL_HEADER, CENTRAL_HEADER = 0x04034B50, 0x02014B50
END, END64, END64_LOCATOR = 0x06054B50, 0x06064B50, 0x07064B50
LOCAL_LAYOUT, CENTRAL_LAYOUT = "<IHHHHHIIIHH", "<IHHHHHHIIIHHHHHII"
END_LAYOUT, END64_LAYOUT, LOCATOR_LAYOUT = "<IHHHHIIH", "<IQHHIIQQQQ", "<IIQI"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF
ZIP64_FIELD = 1


class ZipWriter:
    """Stored members written one after the other, with ZIP64 records always present."""

    def __init__(self, out) -> None:
        self.out, self.at, self.members = out, 0, []

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, parts: list[bytes]) -> int:
        """Write a member; where its data begins."""
        encoded, begin = name.encode(), self.at
        size, check = sum(map(len, parts)), 0
        for part in parts:
            check = zlib.crc32(part, check)
        extra = struct.pack("<HHQQ", ZIP64_FIELD, 16, size, size)
        self.write(struct.pack(LOCAL_LAYOUT, LOCAL_HEADER, 45, 0x800, 0, 0, 0x21, check, FULL32, FULL32, len(encoded), len(extra)))
        self.write(encoded + extra)
        data = self.at
        for part in parts:
            self.write(part)
        self.members.append((encoded, check, size, begin))
        return data

    def close(self) -> None:
        begin = self.at
        for name, check, size, header in self.members:
            extra = struct.pack("<HHQQQ", ZIP64_FIELD, 24, size, size, header)
            self.write(
                struct.pack(
                    CENTRAL_LAYOUT, CENTRAL_HEADER, 45, 45, 0x800, 0, 0, 0x21, check, FULL32, FULL32, len(name), len(extra), 0, 0, 0, 0, FULL32
                )
            )
            self.write(name + extra)
        size, count, end64 = self.at - begin, len(self.members), self.at
        self.write(struct.pack(END64_LAYOUT, END64, 44, 45, 45, 0, 0, count, count, size, begin))
        self.write(struct.pack(LOCATOR_LAYOUT, END64_LOCATOR, 0, end64, 1))
        self.write(struct.pack(END_LAYOUT, END, 0, 0, min(count, FULL16), min(count, FULL16), FULL32, FULL32, 0))


def _range(file, at: int, size: int) -> bytes:
    file.seek(at)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"the archive ends before byte {at + size}")
    return data


def zip_members(file) -> dict[str, tuple[int, int, int]]:
    """Name to (method, place of the data, size), from the central directory; with or without ZIP64."""
    file.seek(0, 2)
    whole = file.tell()
    tail_at = max(0, whole - 22 - FULL16 - 20)
    tail = _range(file, tail_at, whole - tail_at)
    place = tail.rfind(struct.pack("<I", END))
    while place >= 0 and (place + 22 > len(tail) or place + 22 + struct.unpack_from("<H", tail, place + 20)[0] != len(tail)):
        place = tail.rfind(struct.pack("<I", END), 0, place)  # those bytes may stand in the comment too
    if place < 0:
        raise ValueError("not a ZIP archive")
    _, _, _, _, count, size, begin, _ = struct.unpack_from(END_LAYOUT, tail, place)
    if place >= 20 and (count == FULL16 or FULL32 in (size, begin)):
        signature, _, end64, _ = struct.unpack_from(LOCATOR_LAYOUT, tail, place - 20)
        if signature == END64_LOCATOR:
            fields = struct.unpack(END64_LAYOUT, _range(file, end64, struct.calcsize(END64_LAYOUT)))
            if fields[0] != END64:
                raise ValueError("no ZIP64 end record where the locator points")
            count, size, begin = fields[7:10]
    directory, at, members = _range(file, begin, size), 0, {}
    for _ in range(count):
        entry = struct.unpack_from(CENTRAL_LAYOUT, directory, at)
        if entry[0] != CENTRAL_HEADER:
            raise ValueError("the central directory is damaged")
        method, packed, full, name_size, extra_size, comment_size, header = (entry[i] for i in (4, 8, 9, 10, 11, 12, 16))
        at += struct.calcsize(CENTRAL_LAYOUT)
        name = directory[at : at + name_size].decode()
        extra = directory[at + name_size : at + name_size + extra_size]
        at += name_size + extra_size + comment_size
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == ZIP64_FIELD:  # holds, in this order, only what doesn't fit 32 bits
                wide = iter(struct.unpack(f"<{length // 8}Q", extra[4 : 4 + length // 8 * 8]))
                full = next(wide) if full == FULL32 else full
                packed = next(wide) if packed == FULL32 else packed
                header = next(wide) if header == FULL32 else header
            extra = extra[4 + length :]
        local = struct.unpack(LOCAL_LAYOUT, _range(file, header, struct.calcsize(LOCAL_LAYOUT)))
        if local[0] != LOCAL_HEADER:
            raise ValueError("no local header where the directory points")
        members[name] = (method, header + struct.calcsize(LOCAL_LAYOUT) + local[9] + local[10], packed)
    return members


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, date: str = DATE, place: str = "") -> bytes:
    """One WARC record; a revisit has no block.

    The response that revisits refer to is named by its page alone; all others by their ``place`` too, which
    differs between records. Rows that repeat a page with its payload are the same record.
    """
    revisit = refers_to is not None
    block = b"" if revisit else payload
    named = not revisit and page_id is not None and len(payload) >= REVISIT_BYTES
    name = f"<urn:page:{'null' if page_id is None else page_id}{'' if named else ':' + place}>"
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + " ".join(url.split()),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: text/html; charset=utf-8",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        fields.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        fields.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(fields["Content-Length"])
    if len(rest) != size + 4:
        raise ValueError("the length of a record is wrong")
    return fields, rest[:size]


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): which record each page is to become."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    digests = rows.where(F.octet_length("payload") >= REVISIT_BYTES).select("page_id", F.sha2("payload", 256).alias("digest"))
    repeated = staged(
        digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-payloads"
    )
    # 80 bytes a row: broadcast up to 16 MB
    small = F.broadcast(repeated) if repeated.limit(200_001).count() <= 200_000 else repeated
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    return rows.join(small, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, date: str = DATE) -> DataFrame:
    """Write every page of ``pages``, as ``with_revisits`` gives them; (archive, records) of each archive.

    ``date`` is when the pages were taken, the same for all, as the table says nothing of it.

    A task writes archives of about ARCHIVE_BYTES under names of its own attempt, so an attempt that
    is lost or repeated leaves at most files that no list names.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        attempt = uuid.uuid4().hex
        records: list[bytes] = []
        size = number = 0

        def flush() -> pa.RecordBatch:
            uri = f"{folder}/{part:06d}-{uuid.uuid4().hex}.zip"
            index, at = [], 0
            for item in records:
                index.append(struct.pack("<QQ", at, len(item)))
                at += len(item)
            with files.open_new(uri + ".part") as out:
                archive = ZipWriter(out)
                archive.add(WARC_MEMBER, records)
                archive.add(INDEX_MEMBER, index)
                archive.close()
            files.publish(uri + ".part", uri)
            return pa.RecordBatch.from_pydict({"archive": [uri], "records": pa.array([len(records)], pa.int64())})

        for batch in batches:
            columns = [batch.column(name) for name in ("page_id", "url", "payload", "digest", "refers_to")]
            for row in range(batch.num_rows):
                number += 1
                item = record(*(column[row].as_py() for column in columns), date, f"{attempt}-{number}")
                records.append(item)
                size += len(item)
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    records, size = [], 0
        if records:
            yield flush()

    return staged(pages.mapInArrow(written, "archive string, records long"), "archives")


def read_archives(spark: SparkSession, archives: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of the archives named in column ``archive``, from their directories and indexes.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for a
    revisit, or if ``payload`` is false; it is read and checked all the same). One task locates the records of an archive; runs of READ_RECORDS are then read apart.
    """

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                with files.open_read(uri) as file:
                    members = zip_members(file)
                    (method, data, _), (index_method, index, size) = members[WARC_MEMBER], members[INDEX_MEMBER]
                    if method or index_method:
                        raise ValueError("only stored members can be read by range")
                    entries = list(struct.iter_unpack("<QQ", _range(file, index, size)))
                runs = [entries[low : low + READ_RECORDS] for low in range(0, len(entries), READ_RECORDS)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "archive": [uri] * len(runs),
                        "begin": pa.array([data + run[0][0] for run in runs], pa.int64()),
                        "sizes": pa.array([[length for _, length in run] for run in runs], pa.list_(pa.int64())),
                    }
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda text: None if text is None or text.startswith("<urn:page:null") else int(text[10:-1].split(":")[0])
        for batch in batches:
            for uri, begin, sizes in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                rows = []
                with files.open_read(uri) as file:
                    at = begin
                    for size in sizes:
                        fields, block = parse_record(_range(file, at, size))
                        at += size
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
                        length = len(block) if kind == "response" else int(fields["X-Payload-Length"])
                        rows.append(
                            (
                                number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], length, digest, kind,
                                number(fields.get("WARC-Refers-To")), block if payload and kind == "response" else None,
                            )
                        )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names
                )

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    parts = max(1, archives.limit(10_000).count())
    places = archives.select("archive").repartition(parts).mapInArrow(located, "archive string, begin long, sizes array<long>")
    runs = places.repartition(spark.sparkContext.defaultParallelism * 4)
    return runs.mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )
