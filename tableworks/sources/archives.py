"""Text inside zip archives, plain or nested, read by Python on the executors.

A deflate stream cannot be split, so a member is read by one task; archives spread over
tasks by size. Lines leave a task in blocks, never as a whole file.
"""

from __future__ import annotations

import io
import re
import shutil
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINES = "archive string, member string, header string, line_no long, line string"
BLOCK = 4 << 20

# How the names of nested archives map to tables and parts.
SKIPPED_PREFIX = "sample"
TABLE_PATTERN = r"^(.+?)\s+(?:file\s+)?PPUF"
PART_PATTERN = r"part (\d+)"


def _text_blocks(stream: BinaryIO, encoding: str) -> Iterator[list[str]]:
    """Lists of complete lines, about ``BLOCK`` bytes each; blank lines are skipped."""
    rest = b""
    while chunk := stream.read(BLOCK):
        head, newline, tail = chunk.rpartition(b"\n")
        if not newline:
            rest += chunk
            continue
        yield [text for text in (rest + head).decode(encoding).split("\n") if text.strip("\r")]
        rest = tail
    if rest.strip(b"\r"):
        yield [rest.decode(encoding)]


@dataclass(frozen=True)
class Reading:
    """What to read: inner archives or first members, and only members of these tables.

    ``tables`` None takes every inner archive, an empty list those that are some table.
    """

    nested: bool = False
    encoding: str = "UTF-8"
    headers_only: bool = False
    tables: tuple[str, ...] | None = None

    def wants(self, member: str) -> bool:
        if not member.lower().endswith(".zip"):
            return False
        if self.tables is None:
            return True
        found = re.match(TABLE_PATTERN, member)
        if not found or member.startswith(SKIPPED_PREFIX):
            return False
        return not self.tables or found[1].strip().replace(" ", "_") in self.tables


def member_batches(
    archive: str, member: str, stream: BinaryIO, reading: Reading
) -> Iterator[pa.RecordBatch]:
    number, header = 0, None
    for lines in _text_blocks(stream, reading.encoding):
        if not lines:
            continue
        if header is None:
            header = lines[0].rstrip("\r")
        if reading.headers_only:
            lines = lines[:1]
        count = len(lines)
        yield pa.record_batch(
            {
                "archive": pa.array([archive] * count, pa.string()),
                "member": pa.array([member] * count, pa.string()),
                "header": pa.array([header] * count, pa.string()),
                "line_no": pa.array(range(number, number + count), pa.int64()),
                "line": pa.array([line.rstrip("\r") for line in lines], pa.string()),
            }
        )
        number += count
        if reading.headers_only:
            return


def _archive_batches(
    path: str, source: BinaryIO | str, reading: Reading
) -> Iterator[pa.RecordBatch]:
    with zipfile.ZipFile(source) as bundle:
        if not reading.nested:
            first = bundle.namelist()[0]
            with bundle.open(first) as stream:
                yield from member_batches(path, first, stream, reading)
            return
        for name in bundle.namelist():
            # What is not wanted stays packed.
            if not reading.wants(name):
                continue
            # The inner archive needs a seekable copy; it lives as long as this loop step.
            with bundle.open(name) as packed, tempfile.TemporaryFile() as inner:
                shutil.copyfileobj(packed, inner)
                with zipfile.ZipFile(inner) as table, table.open(table.namelist()[0]) as stream:
                    yield from member_batches(path, name, stream, reading)


def _read_contents(batches, reading: Reading) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            yield from _archive_batches(path.as_py(), io.BytesIO(content.as_buffer()), reading)


def _read_mounted(batches, reading: Reading) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            yield from _archive_batches(path, path.removeprefix("file:"), reading)


def archive_lines(archives: DataFrame, reading: Reading = Reading()) -> DataFrame:
    """(archive, member, header, line_no, line) from a table of (path, content)."""
    return archives.select("path", "content").mapInArrow(partial(_read_contents, reading=reading), LINES)


def scan_zip_text(
    spark: SparkSession,
    path: str,
    nested: bool = False,
    encoding: str = "UTF-8",
    mounted: bool = False,
    tables: Sequence[str] | None = None,
    headers_only: bool = False,
) -> DataFrame:
    """Lines of the first member of each archive, or of inner archives when nested.

    ``tables`` keeps to the inner archives of these tables (of any table, when empty); others
    are never unpacked. ``headers_only`` reads the first line of each. The file source packs
    archives into tasks by size. A binary cell ends at 2 GB; for larger archives on storage that
    executors mount, ``mounted`` passes paths only and streams each archive inside its task.
    """
    reading = Reading(nested, encoding, headers_only, None if tables is None else tuple(tables))
    found = spark.read.format("binaryFile").load(path)
    if not mounted:
        return archive_lines(found, reading)
    return found.select("path").mapInArrow(partial(_read_mounted, reading=reading), LINES)


def member_table(member: Column) -> Column:
    """Folder-style table name of a nested archive; null when the name is no table."""
    table = F.replace(
        F.trim(F.regexp_extract(member, TABLE_PATTERN, 1)), F.lit(" "), F.lit("_")
    )
    return F.when(
        ~F.startswith(member, F.lit(SKIPPED_PREFIX)) & F.rlike(member, F.lit(TABLE_PATTERN)),
        table,
    )


def route_member(member: Column, quarter: Column) -> Column:
    """``table/quarter[_partN].parquet`` of a nested archive; null when it is no table."""
    part = F.regexp_extract(member, PART_PATTERN, 1)
    suffix = F.when(part != "", F.concat(F.lit("_part"), part)).otherwise("")
    return F.concat(
        member_table(member), F.lit("/"), quarter, suffix, F.lit(".parquet")
    )
