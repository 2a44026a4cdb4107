"""Rows that cannot be read, set apart from the good ones in one scan.

The readers here return every row with a ``reason``, null for good rows. ``split`` writes that table
once, counts both kinds while it is written, and hands out good rows and rejects from the copy.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from . import delimited, fixed_width
from .events_json import company_events

#: Where a rejected line of a file came from.
ORIGIN = ("file", "block")


class TooManyRejects(ValueError):
    """A larger share of the rows was rejected than the caller allows."""


@dataclass(frozen=True)
class Checked:
    good: DataFrame
    rejects: DataFrame
    rows: int
    rejected: int


def split(
    parsed: DataFrame, *, columns: Iterable[str], about: Iterable[str], max_share: float = 0.01
) -> Checked:
    """Good rows (``columns``) and rejects (``about`` and ``reason``) of a table with a ``reason``.

    The input is read once. Rows and rejects are counted by the tasks that write the copy, and a
    share of rejects above ``max_share`` is an error, raised before anything is handed out. The copy
    goes with the enclosing ``scratch`` block. An empty table has no rejects.
    """
    counts = Observation("read")
    seen = parsed.observe(counts, F.count(F.lit(1)).alias("rows"), F.count("reason").alias("rejected"))
    copy = stored(seen, "checked")
    rows, rejected = counts.get["rows"], counts.get["rejected"]
    if rejected > max_share * rows:
        raise TooManyRejects(f"{rejected} of {rows} rows are rejected, more than {max_share:.2%}")
    bad = F.col("reason").isNotNull()
    return Checked(
        copy.where(~bad).select(*columns), copy.where(bad).select(*about, "reason"), rows, rejected
    )


# ---------------------------------------------------------------- delimited text


def read_delimited(
    spark: SparkSession, path: str, sep: str, quote: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """As ``parse_delimited_strings``, but a ragged line is a row with its text and a reason.

    Beside the columns of the headers there are ``file``, ``block`` (the byte at which the task's
    part of the file begins), ``line`` (null for good rows) and ``reason``.
    """
    files = spark.read.text(path).inputFiles()
    by_header: dict[str, list[str]] = {}
    for file, header in zip(files, delimited.file_headers(spark, files, encoding), strict=True):
        if header:
            by_header.setdefault(header, []).append(file)
    options = delimited.text_options(sep, quote, encoding)
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "line"}
    parts = []
    for _, own in sorted(by_header.items()):
        names = spark.read.options(header="true", **options).csv(own).columns
        fields = ", ".join(f"`{name}` string" for name in [*names, "line"])
        table = spark.read.options(header="true", **options).schema(fields).csv(own)
        ragged = F.lit(f"not {len(names)} fields")
        parts.append(
            table.select(
                *[F.coalesce(f"`{name}`", F.lit("")).alias(name) for name in names],
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                "line",
                F.when(F.col("line").isNotNull(), ragged).alias("reason"),
            )
        )
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def delimited_strings(
    spark: SparkSession,
    path: str,
    sep: str,
    quote: str | None = None,
    encoding: str = "UTF-8",
    max_share: float = 0.01,
) -> Checked:
    """Delimited text, and its ragged lines as (file, block, line, reason)."""
    parsed = read_delimited(spark, path, sep, quote, encoding)
    about = [*ORIGIN, "line"]
    columns = [name for name in parsed.columns if name not in (*about, "reason")]
    return split(parsed, columns=columns, about=about, max_share=max_share)


# ---------------------------------------------------------------- fixed width


def fixed_width_lines(
    lines: DataFrame,
    layout: Iterable[tuple[str, int, int, fixed_width.Field]] = fixed_width.QUOTE_LAYOUT,
    record_type: str = fixed_width.QUOTE_RECORD,
    price_scale: float = fixed_width.PRICE_SCALE,
    max_share: float = 0.01,
) -> Checked:
    """Fixed-width records, and those that cannot be read as (other columns, value, reason).

    ``lines`` may bring more columns than ``value``, such as file and block; rejects keep them. The
    reason names every field that does not read, or says that the line is too short for its fields.
    """
    layout = tuple(layout)
    names = [name for name, *_ in layout]
    about = lines.columns
    clashing = set(names) & set(about)
    if clashing:
        raise ValueError(f"columns named like fields: {sorted(clashing)}")
    parsed = fixed_width.read_fixed_width(lines, layout, record_type, price_scale)
    return split(parsed, columns=names, about=about, max_share=max_share)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as bytes, with the file and the block that they come from."""
    return spark.read.text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


# ---------------------------------------------------------------- company documents


def company_documents(
    df: DataFrame, json_col: str, company_col: str, max_share: float = 0.01
) -> Checked:
    """Events of company documents, and the documents that are skipped, with the reason.

    One bad event rejects its whole document, as none of a company's events can be relied on then.
    Good rows are events; the counts are of documents.
    """
    company, document = F.col(company_col), F.col(json_col)
    parsed = df.select(
        company.alias("issuing_company"),
        document.alias("document"),
        company_events(document).alias("_company"),
    ).select("issuing_company", "document", "_company.*")
    checked = split(
        parsed,
        columns=["issuing_company", "events"],
        about=["issuing_company", "document"],
        max_share=max_share,
    )
    events = checked.good.select("issuing_company", F.inline("events"))
    return Checked(events, checked.rejects, checked.rows, checked.rejected)

