"""Files in a folder that all executors share, named by URI."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

from citygrain.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder under the checkpoint folder; it appears with its first file."""
    return shared_folder(spark, name)


def _local(uri: str) -> str | None:
    parsed = urlparse(uri)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def _remote(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def open_new(uri: str):
    """A file for writing that is complete under its name only after ``publish``."""
    path = _local(uri)
    if path is None:
        system, path = _remote(uri)
        return system.open_output_stream(path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    return open(path, "wb")


def publish(source: str, target: str) -> None:
    """Give a finished file its name; a second attempt of a task replaces the file by an equal one."""
    path = _local(source)
    if path is None:
        system, path = _remote(source)
        system.move(path, _remote(target)[1])
    else:
        os.replace(path, _local(target))


def write_file(uri: str, data: bytes) -> None:
    """Write a file so that other tasks see all of it or nothing."""
    part = f"{uri}.{uuid.uuid4().hex}"
    with open_new(part) as out:
        out.write(data)
    publish(part, uri)


def open_read(uri: str):
    """A file for ranged reads."""
    path = _local(uri)
    if path is None:
        system, path = _remote(uri)
        return system.open_input_file(path)
    return open(path, "rb")


def mapped(uri: str) -> memoryview:
    """The bytes of a file, memory-mapped.

    A file of a remote store is copied once into an unnamed local file, which goes with the process.
    """
    path = _local(uri)
    if path is not None:
        with open(path, "rb") as file:
            size = os.fstat(file.fileno()).st_size
            return memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)) if size else memoryview(b"")
    with open_read(uri) as source, tempfile.TemporaryFile() as file:
        while part := source.read(1 << 22):
            file.write(part)
        file.flush()
        return memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)) if file.tell() else memoryview(b"")
