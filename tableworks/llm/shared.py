"""Which rows models learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hashed_sample(df: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` different rows, picked by their hashes; all of them where there are fewer.

    Which rows are picked depends on nothing but the rows and their number. Tasks drop the others
    where they stand, so what leaves a task is its share of the sample.
    """
    total, whole = df.count(), 1 << 30
    share = min(whole, int(rows * whole / max(total, 1)) + 1)
    return df.where(F.pmod(F.xxhash64(*df.columns), F.lit(whole)) < share).distinct()


def training_row(doc_id) -> F.Column:
    """Whether models may learn from a document; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))
