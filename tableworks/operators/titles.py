"""Clean-up of a title catalog read from delimited text, where every column is a string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dropped and renamed columns, the text that stands for "no value", and the
# genre given to titles without one.
DROPPED = ("originalTitle", "endYear")
RENAMED = {
    "tconst": "id",
    "titleType": "type",
    "isAdult": "is_adult",
    "startYear": "year",
    "runtimeMinutes": "time_min",
    "genres": "gens",
}
NO_VALUE = r"\N"
NO_GENRE = "non-categorized"


def rename_and_drop(df: DataFrame) -> DataFrame:
    return df.drop(*DROPPED).withColumnsRenamed(RENAMED)


def filter_equals(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.col(column) == value)


def split_or_default(text: Column | str, default: str = NO_GENRE) -> Column:
    """Comma-separated text as an array; one default element when there is no value."""
    text = F.col(text) if isinstance(text, str) else text
    given = F.nullif(F.nullif(text, F.lit("")), F.lit(NO_VALUE))
    return F.coalesce(F.split(given, ","), F.array(F.lit(default)))


def clean_titles(df: DataFrame, kind: str = "movie") -> DataFrame:
    """Renamed catalog of one kind of title, genres as an array."""
    kept = filter_equals(rename_and_drop(df), "type", kind)
    return kept.withColumn("gens", split_or_default("gens"))
