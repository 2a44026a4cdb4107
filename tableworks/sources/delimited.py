"""Delimited text with a header row; every column stays a string."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text_options(sep: str, quote: str | None, encoding: str = "UTF-8") -> dict[str, str]:
    """Reader settings: a doubled quote is the only escape, and a ragged row is an error.

    Without a quote character nothing is special but the separator.
    """
    return {
        "sep": sep,
        "quote": quote or "",
        "escape": quote or "\0",
        "encoding": encoding,
        "mode": "FAILFAST",
        # Pruned columns are not tokenised, which would let ragged rows pass.
        "columnPruning": "false",
    }


def file_headers(spark: SparkSession, files: Sequence[str], encoding: str) -> list[str]:
    """The first line of each file, packed or not: a few kB of each, read side by side."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(name: str) -> str:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = path.getFileSystem(conf).open(path)
        codec = codecs.getCodec(path)
        plain = codec.createInputStream(stream) if codec else stream
        try:
            reader = jvm.java.io.InputStreamReader(plain, encoding)
            return jvm.java.io.BufferedReader(reader).readLine() or ""
        finally:
            stream.close()

    with ThreadPool(16) as pool:
        return pool.map(header, files)


def parse_delimited_strings(
    spark: SparkSession, path: str, sep: str, quote: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    r"""Files (plain or ``.gz``) as strings; an empty field is ``""`` and ``\N`` stays text.

    Every file is read by its own header: a folder may hold files with other column orders.
    A column that some files lack is null in their rows. A gzip file cannot be split and is one
    task; spread a few large ones afterwards. Reading never skips columns, because a skipped one
    would hide ragged rows: convert large text once and query the table.
    """
    read = spark.read.options(header="true", **text_options(sep, quote, encoding))
    files = spark.read.text(path).inputFiles()
    by_header: dict[str, list[str]] = {}
    for file, header in zip(files, file_headers(spark, files, encoding), strict=True):
        if header:
            by_header.setdefault(header, []).append(file)
    if len(by_header) < 2:
        return read.csv(path).na.fill("")
    parts = [read.csv(own).na.fill("") for _, own in sorted(by_header.items())]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def scan_gzip_text(
    spark: SparkSession,
    path: str,
    sep: str = "\t",
    quote: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Gzip text as strings, spread over ``partitions`` tasks after reading when given."""
    table = parse_delimited_strings(spark, path, sep, quote)
    return table.repartition(partitions) if partitions else table


def parse_lines(
    lines: DataFrame,
    columns: Sequence[str],
    sep: str,
    quote: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns from a table of ``line`` values already freed of their header."""
    options = text_options(sep, quote)
    del options["columnPruning"]
    fields = F.from_csv("line", ", ".join(f"`{name}` string" for name in columns), options)
    return lines.select(*keep, fields.alias("_fields")).select(*keep, "_fields.*").na.fill("")


def parse_headed_lines(
    lines: DataFrame,
    headers: Sequence[str],
    sep: str,
    quote: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns from lines that carry their member's ``header``, for the given headers.

    Members of other column orders come out under the right names; a column that some members
    lack is null in their rows.
    """
    parts = []
    for header in headers:
        names = next(csv.reader([header], delimiter=sep, quotechar=quote)) if quote else header.split(sep)
        own = lines.where((F.col("header") == header) & (F.col("line_no") > 0))
        parts.append(parse_lines(own, names, sep, quote, keep))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
