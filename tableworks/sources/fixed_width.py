"""Fixed-width text to typed columns, in one projection over a table of lines."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from enum import Enum
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Field(Enum):
    """How the bytes of a field read."""

    TEXT = "text"
    INT = "whole number"
    PRICE = "number with implied decimals"
    DATE = "date as yyyyMMdd"


# The record layout of the daily quote file (1-based, inclusive positions).
QUOTE_LAYOUT = (
    ("trade_date", 3, 10, Field.DATE),
    ("bdi_code", 11, 12, Field.TEXT),
    ("ticker", 13, 24, Field.TEXT),
    ("market_type", 25, 27, Field.TEXT),
    ("company_name", 28, 39, Field.TEXT),
    ("specification", 40, 49, Field.TEXT),
    ("forward_term", 50, 52, Field.TEXT),
    ("currency", 53, 56, Field.TEXT),
    ("open_price", 57, 69, Field.PRICE),
    ("high_price", 70, 82, Field.PRICE),
    ("low_price", 83, 95, Field.PRICE),
    ("average_price", 96, 108, Field.PRICE),
    ("close_price", 109, 121, Field.PRICE),
    ("best_bid_price", 122, 134, Field.PRICE),
    ("best_ask_price", 135, 147, Field.PRICE),
    ("total_trades", 148, 152, Field.INT),
    ("total_quantity", 153, 170, Field.INT),
    ("total_volume", 171, 188, Field.PRICE),
    ("strike_price", 189, 201, Field.PRICE),
    ("correction_indicator", 202, 202, Field.TEXT),
    ("expiration_date", 203, 210, Field.DATE),
    ("quote_factor", 211, 217, Field.INT),
    ("strike_points", 218, 230, Field.INT),
    ("isin_code", 231, 242, Field.TEXT),
    ("distribution_number", 243, 245, Field.INT),
)
QUOTE_RECORD = "01"
PRICE_SCALE = 100.0
ENCODING = "ISO-8859-1"

# The whitespace a text field is trimmed of (Latin-1 range).
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"


@dataclass(frozen=True)
class _Reader:
    """Casts one slice of a line; a strict reader fails on bad input, a lax one gives null.

    Slices are bytes: Latin-1 has one byte per character, so a slice is found by its offset
    without walking the line, and only text is decoded. The byte 1 stands for a blank.
    """

    strict: bool
    price_scale: float

    def whole(self, raw: Column) -> Column:
        digits = raw.cast("string")
        if not self.strict:
            return digits.try_cast("long")
        # A cast alone would forgive blanks and control bytes around the digits.
        wrong = F.raise_error(F.concat(F.lit("not a whole number: "), digits)).cast("long")
        right = digits.isNull() | F.rlike(digits, F.lit("^-?[0-9]+$"))
        return F.when(right, digits.cast("long")).otherwise(wrong)

    def read(self, raw: Column, kind: Field) -> Column:
        match kind:
            case Field.TEXT:
                text = F.replace(F.decode(raw, ENCODING), F.lit("\x01"), F.lit(" "))
                # The padding goes first: trimming a set of characters walks all that is left.
                return F.btrim(F.rtrim(text), F.lit(_BLANKS))
            case Field.INT:
                return self.whole(raw)
            case Field.PRICE:
                return self.whole(raw) / self.price_scale
            case Field.DATE:
                return (F.to_date if self.strict else F.try_to_date)(raw.cast("string"), "yyyyMMdd")
        raise ValueError(f"unknown field kind {kind!r}")


def _line_bytes(lines: DataFrame) -> Column:
    """The bytes of ``value``; text is encoded once for each line.

    Merged into the projection of the fields, it would be encoded once for each field. Spark
    merges nothing over a generator.
    """
    if dict(lines.dtypes)["value"] == "string":
        return F.explode(F.array(F.encode("value", ENCODING)))
    return F.col("value")


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as raw bytes; files are split across tasks."""
    return spark.read.text(path).select(F.col("value").cast("binary").alias("value"))


def parse_fixed_width(
    lines: DataFrame,
    layout: Iterable[tuple[str, int, int, Field]] = QUOTE_LAYOUT,
    record_type: str = QUOTE_RECORD,
    price_scale: float = PRICE_SCALE,
    strict: bool = True,
) -> DataFrame:
    """Typed columns from the single ``value`` column of ``lines`` (text or Latin-1 bytes).

    Header and trailer lines have another record type in their first two characters.
    """
    reader = _Reader(strict, price_scale)
    return (
        lines.select(_line_bytes(lines).alias("line"))
        .where(F.substring("line", 1, 2) == F.lit(record_type.encode()))
        .select(
            *[
                reader.read(F.substring("line", start, end - start + 1), kind).alias(name)
                for name, start, end, kind in layout
            ]
        )
    )


def read_fixed_width(
    lines: DataFrame,
    layout: Iterable[tuple[str, int, int, Field]] = QUOTE_LAYOUT,
    record_type: str = QUOTE_RECORD,
    price_scale: float = PRICE_SCALE,
) -> DataFrame:
    """Every record with its typed fields, the columns of ``lines`` and a ``reason``.

    The reason is null where all fields read; elsewhere fields that do not are null.
    """
    layout = tuple(layout)
    reader = _Reader(False, price_scale)
    fields = []
    for name, start, end, kind in layout:
        raw = F.substring("_line", start, end - start + 1)
        if kind in (Field.INT, Field.PRICE):
            # A cast alone would forgive blanks and control bytes around the digits.
            right = F.rlike(raw.cast("string"), F.lit("^-?[0-9]+$"))
            raw = F.when(right, raw)
        fields.append(reader.read(raw, kind).alias(name))
    # Each field is read once: the reason looks at what was read, not at the bytes again.
    wrong = [F.when(F.col(name).isNull(), name) for name, _, _, kind in layout if kind is not Field.TEXT]
    short = F.length("_line") < max(end for _, _, end, _ in layout)
    unread = reduce(or_, (mark.isNotNull() for mark in wrong), F.lit(False))
    named = F.concat(F.lit("unreadable: "), F.concat_ws(", ", *wrong))
    reason = F.when(short, "line too short").when(unread, named)
    parsed = (
        lines.withColumn("_line", _line_bytes(lines))
        .where(F.substring("_line", 1, 2) == F.lit(record_type.encode()))
        .select(*lines.columns, "_line", *fields)
    )
    return parsed.select(*lines.columns, *[name for name, *_ in layout], reason.alias("reason"))
