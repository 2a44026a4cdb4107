"""From raw quotes to comparable stock prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .indicators import PRICES

# Codes of the cash market and the standard lot, the tag of depositary
# receipts, and the columns later steps use.
CASH_MARKET = "010"
STANDARD_LOT = "02"
DEPOSITARY_TAG = "DRN"
STOCK_COLUMNS = (
    "trade_date",
    "year",
    "ticker",
    "company_name",
    "specification",
    "isin_code",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "total_trades",
    "total_quantity",
    "total_volume",
    "quote_factor",
)


def filter_stocks(df: DataFrame) -> DataFrame:
    """Cash-market stocks in standard lots, without depositary receipts.

    A null specification is dropped too: it does not prove the row is not a receipt.
    """
    return df.where(
        (F.col("market_type") == CASH_MARKET)
        & (F.col("bdi_code") == STANDARD_LOT)
        & ~F.contains("specification", F.lit(DEPOSITARY_TAG))
    ).select(*STOCK_COLUMNS)


def normalize_price(df: DataFrame) -> DataFrame:
    """Prices per single share, plus the session's own move (never rescaled later)."""
    per_share = {price: F.try_divide(price, "quote_factor") for price in PRICES}
    return (
        df.withColumns(per_share)
        .drop("quote_factor")
        .withColumn("day_trade", F.col("close_price") - F.col("open_price"))
    )
