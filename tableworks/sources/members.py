"""Members of zip archives as a Spark data source: one input partition per member.

An archive's directory stands at its end and tells where each member begins. Planning reads only
the directories, by ranged reads; a task then reads only the bytes of its own member, and a header
alone only the first of them. Members therefore spread over tasks however large an archive is,
filters on ``archive`` and ``member`` leave whole partitions out, and nothing is copied to a disk:
an archive inside an archive is inflated twice as it streams by.

Files are reached through pyarrow's file systems, so every executor has to reach the path; paths
that only Spark's readers can open go through ``archives.scan_zip_text``.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from .archives import LINES, Reading, member_batches

NAME = "zip_members"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

# Fixed values of the format: signatures and layouts of a local header and of a data descriptor.
_LOCAL, _DESCRIPTOR = b"PK\x03\x04", b"PK\x07\x08"
_HEADER = struct.Struct("<4s5H3I2H")
_STORED, _DEFLATED = 0, 8
_SIZES_FOLLOW, _ENCRYPTED = 0x08, 0x01
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Member(InputPartition):
    """Where a member stands, and what is needed to unpack it."""

    archive: str
    name: str
    offset: int
    packed: int
    size: int
    method: int
    flags: int
    crc: int

    @property
    def info(self) -> zipfile.ZipInfo:
        info = zipfile.ZipInfo(self.name)
        info.compress_size, info.file_size, info.compress_type = self.packed, self.size, self.method
        info.flag_bits, info.CRC = self.flags, self.crc
        return info


class _Part(io.RawIOBase):
    """A stretch of a seekable file as a file of its own."""

    def __init__(self, file: BinaryIO, start: int, size: int):
        self.file, self.start, self.size, self.at = file, start, size, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        base = {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.size}[whence]
        self.at = max(0, base + offset)
        return self.at

    def readinto(self, buffer) -> int:
        wanted = max(0, min(len(buffer), self.size - self.at))
        self.file.seek(self.start + self.at)
        data = self.file.read(wanted)
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)


class _Chunks(io.RawIOBase):
    """A stream over an iterator of byte strings."""

    def __init__(self, chunks: Iterable[bytes]):
        self.chunks, self.rest = iter(chunks), b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.rest:
            self.rest = next(self.chunks, None)
            if self.rest is None:
                self.rest = b""
                return 0
        size = min(len(buffer), len(self.rest))
        buffer[:size], self.rest = self.rest[:size], self.rest[size:]
        return size


def _exactly(stream: BinaryIO, size: int) -> bytes:
    data = stream.read(size)
    if len(data) < size:
        raise zipfile.BadZipFile("the archive ends early")
    return data


def _first_inflated(stream: BinaryIO) -> Iterator[bytes]:
    """The bytes of the member that stands first in an archive that can only be read onwards."""
    signature, _, flags, method, _, _, crc, packed, size, name, extra = _HEADER.unpack(
        _exactly(stream, _HEADER.size)
    )
    if signature != _LOCAL:
        raise zipfile.BadZipFile("no archive, or an empty one")
    if flags & _ENCRYPTED:
        raise zipfile.BadZipFile("the first member is encrypted")
    _exactly(stream, name + extra)
    found = 0
    if method == _DEFLATED:
        inflater = zlib.decompressobj(-zlib.MAX_WBITS)
        while not inflater.eof:
            packed_chunk = inflater.unconsumed_tail or stream.read(_CHUNK)
            if not packed_chunk:
                raise zipfile.BadZipFile("the archive ends early")
            chunk = inflater.decompress(packed_chunk, _CHUNK)
            found = zlib.crc32(chunk, found)
            yield chunk
        if flags & _SIZES_FOLLOW:
            tail = inflater.unused_data
            tail += stream.read(max(0, 8 - len(tail)))
            at = 4 if tail.startswith(_DESCRIPTOR) else 0
            crc = int.from_bytes(tail[at : at + 4], "little")
    elif method == _STORED and not flags & _SIZES_FOLLOW and size != 0xFFFFFFFF:
        left = size
        while left:
            chunk = _exactly(stream, min(_CHUNK, left))
            left -= len(chunk)
            found = zlib.crc32(chunk, found)
            yield chunk
    else:
        raise zipfile.BadZipFile(f"the first member is stored as {method} without its size")
    if found != crc:
        raise zipfile.BadZipFile("the first member is damaged")


def _file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """A path without a scheme, and Hadoop's ``file:/...``, are local."""
    local = re.match(r"(file:)?(?=/[^/]|[^:]*$)", path)
    if local:
        return pyarrow.fs.LocalFileSystem(), path[local.end() :]
    return pyarrow.fs.FileSystem.from_uri(path)


def archive_paths(path: str) -> list[str]:
    """An archive, or the archives of a folder, by the same kind of path as the one given."""
    files, base = _file_system(path)
    if files.get_file_info(base).type != pyarrow.fs.FileType.Directory:
        return [path]
    root = path[: len(path) - len(base)] if path.endswith(base) else ""
    found = files.get_file_info(pyarrow.fs.FileSelector(base))
    return sorted(root + f.path for f in found if f.is_file and f.path.lower().endswith(".zip"))


def members_of(path: str, open_=None) -> list[Member]:
    """The members of an archive, from its directory alone."""
    files, base = _file_system(path)
    with (open_ or files.open_input_file)(base) as file, zipfile.ZipFile(file) as bundle:
        return [
            Member(path, i.filename, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.flag_bits, i.CRC)
            for i in bundle.infolist()
            if not i.is_dir()
        ]


def unpacked(member: Member, file: BinaryIO, inner: bool) -> BinaryIO:
    """A member's bytes, or those of the first member of the archive that it is."""
    file.seek(member.offset)
    header = _HEADER.unpack(_exactly(file, _HEADER.size))
    if header[0] != _LOCAL:
        raise zipfile.BadZipFile(f"{member.archive}: no member at {member.offset}")
    start = member.offset + _HEADER.size + header[-2] + header[-1]
    if inner and member.method == _STORED:
        bundle = zipfile.ZipFile(io.BufferedReader(_Part(file, start, member.packed), _CHUNK))
        return bundle.open(bundle.namelist()[0])
    packed = io.BufferedReader(_Part(file, start, member.packed), _CHUNK)
    stream = zipfile.ZipExtFile(packed, "r", member.info)
    return io.BufferedReader(_Chunks(_first_inflated(stream)), _CHUNK) if inner else stream


class ZipMembers(DataSource):
    """Options: ``path``, ``nested``, ``first`` (of each archive only), ``encoding``,
    ``headers_only``, ``tables`` (names joined by ``/``; absent: all)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return LINES

    def reader(self, schema: StructType) -> DataSourceReader:
        return PrunedReader(self.options) if self.options.get("pushdown") == "true" else Reader(self.options)


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        flag = {name: options.get(name) == "true" for name in ("nested", "first", "headers_only")}
        self.paths = options["paths"].split("\n")
        self.first = flag["first"]
        chosen = options.get("tables")
        self.reading = Reading(
            flag["nested"],
            options.get("encoding", "UTF-8"),
            flag["headers_only"],
            None if chosen is None else tuple(name for name in chosen.split("/") if name),
        )
        self.only: dict[str, set[str]] = {}

    def partitions(self) -> list[Member]:
        archives = [p for p in self.paths if p in self.only.get("archive", {p})]
        with ThreadPool(16) as pool:
            every = pool.map(members_of, archives)
        if not self.reading.nested:
            kept = [own[:1] if self.first else own for own in every]
        else:
            kept = [[m for m in own if self.reading.wants(m.name)] for own in every]
        names = self.only.get("member")
        return [m for own in kept for m in own if names is None or m.name in names]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        files, base = _file_system(partition.archive)
        with files.open_input_file(base) as file:
            stream = unpacked(partition, file, self.reading.nested)
            yield from member_batches(partition.archive, partition.name, stream, self.reading)


class PrunedReader(Reader):
    """Takes filters on ``archive`` and ``member`` over from Spark."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            values = {one.value} if isinstance(one, EqualTo) else set(one.value) if isinstance(one, In) else None
            name = one.attribute[0] if values is not None and len(one.attribute) == 1 else None
            if name in ("archive", "member"):
                self.only[name] = self.only.get(name, values) & values
            else:
                yield one


def scan_zip_members(
    spark: SparkSession,
    path: str,
    *,
    nested: bool = False,
    first: bool = False,
    encoding: str = "UTF-8",
    headers_only: bool = False,
    tables: Iterable[str] | None = None,
) -> DataFrame:
    """(archive, member, header, line_no, line) of every member, a task for each.

    ``nested`` takes members that are archives and reads the first member of each; ``tables`` keeps
    to those of these tables (of any table, when empty). ``first`` keeps to the first member of each
    archive. Inside a packed archive, the first member is the one that stands first in the file. With
    the session's ``spark.sql.python.filterPushdown.enabled``, filters on ``archive`` and ``member``
    leave partitions out; without it they leave rows out. A folder without archives has no rows.
    """
    spark.dataSource.register(ZipMembers)
    found = archive_paths(path)
    if not found:
        return spark.createDataFrame([], LINES)
    options = {
        "paths": "\n".join(found),
        "nested": str(nested).lower(),
        "first": str(first).lower(),
        "encoding": encoding,
        "headers_only": str(headers_only).lower(),
        "pushdown": spark.conf.get(PUSHDOWN, "false"),
    }
    if tables is not None:
        options["tables"] = "/".join(tables)
    return spark.read.format(NAME).options(**options).load()
