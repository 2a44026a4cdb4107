"""Raw archives to tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources import archives, delimited, fixed_width, members, tables


def convert_quotes_zip(
    spark: SparkSession, source: str, target: str, *, fmt: str = "parquet", mounted: bool = False
) -> str:
    """Zipped fixed-width quotes to a table by year; returns its path."""
    lines = archives.scan_zip_text(spark, source, encoding=fixed_width.ENCODING, mounted=mounted)
    quotes = fixed_width.parse_fixed_width(lines.select(F.col("line").alias("value")))
    dated = quotes.withColumns(tables.year_of("trade_date"))
    tables.sink_overwrite(dated, target, ["year"], fmt)
    return target


def convert_nested_zip(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    sep: str = "|",
    encoding: str = fixed_width.ENCODING,
    fmt: str = "parquet",
    mounted: bool = False,
    by_member: bool = False,
) -> dict[str, str]:
    """One table per route of nested archives, by quarter; returns their paths by name.

    The quarter is the outer archive's name. Headers are read first: they tell the tables and
    their columns. Each table then unpacks its own members alone. ``by_member``, for archives that
    executors reach by pyarrow, reads each member by a task of its own and only its bytes.
    """
    if by_member:
        scan, options = members.scan_zip_members, {"nested": True, "encoding": encoding}
    else:
        scan = archives.scan_zip_text
        options = {"nested": True, "encoding": encoding, "mounted": mounted}
    found = scan(spark, source, tables=[], headers_only=True, **options)
    routed = found.select(archives.member_table(F.col("member")).alias("table"), "header")
    headers: dict[str, list[str]] = {}
    for table, header in sorted(map(tuple, routed.distinct().collect())):
        headers.setdefault(table, []).append(header)
    for table, own in headers.items():
        lines = scan(spark, source, tables=[table], **options)
        quarter = F.regexp_extract("archive", r"([^/]+)\.zip$", 1)
        rows = delimited.parse_headed_lines(
            lines.withColumn("quarter", quarter), own, sep, keep=["quarter"]
        )
        tables.sink_overwrite(rows, f"{target}/{table}", ["quarter"], fmt)
    return {table: f"{target}/{table}" for table in headers}
