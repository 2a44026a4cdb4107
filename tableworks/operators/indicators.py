"""Rolling indicators of a price series. A frame of n rows covers n sessions, not n days."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import signed_log
from .series import last_rows, rolling_medians, running_sum, series_window

# The price columns, and the factor that makes MAD comparable to a deviation.
PRICES = ("open_price", "high_price", "low_price", "close_price")
MAD_SCALE = 0.6745

# Where the rows of a series are: what every operator below takes, whole or cut (``series``).
KEY, ORDER = "ticker", "trade_date"


def log_columns() -> dict[str, Column]:
    """Logarithms of the prices, and the odd logarithm of the session's own move."""
    logs = {f"log_{price}": F.log1p(price) for price in PRICES}
    return logs | {"log_day_trade": signed_log("day_trade")}


def log_features(df: DataFrame) -> DataFrame:
    return df.withColumns(log_columns())


def log_return(df: DataFrame, *, key: str = KEY, order: str = ORDER) -> DataFrame:
    """``ln(close / previous close)``. Looks back one row."""
    previous = F.lag("close_price").over(series_window(df, key, order))
    return df.withColumn("log_return", F.ln(F.try_divide("close_price", previous)))


def rolling_sample(
    df: DataFrame, *, value: str, rows: int, out: str, key: str = KEY, order: str = ORDER
) -> DataFrame:
    """The non-null values of the last ``rows`` rows, in their order."""
    return df.withColumn(out, F.collect_list(value).over(last_rows(df, key, order, rows)))


def rolling_median_mad(
    df: DataFrame, *, value: str, rows: int, prefix: str, key: str = KEY, order: str = ORDER
) -> DataFrame:
    """Exact median and MAD of the last ``rows`` rows, nulls left out."""
    return rolling_medians(df, [(value, rows, prefix)], key=key, order=order)


def zscore_from(value: str, prefix: str, scale: float = MAD_SCALE) -> Column:
    """Modified z-score from a median and a MAD; null unless the MAD is positive."""
    distance = F.col(value) - F.col(f"{prefix}_median")
    mad = F.col(f"{prefix}_mad")
    return F.when(mad > 0, scale * distance / mad)


def modified_zscore(
    df: DataFrame,
    *,
    value: str,
    out: str,
    rows: int = 90,
    scale: float = MAD_SCALE,
    key: str = KEY,
    order: str = ORDER,
) -> DataFrame:
    """Modified z-score of ``value`` against the median and MAD of the last ``rows`` rows."""
    measured = rolling_medians(df, [(value, rows, "_z")], key=key, order=order)
    return measured.withColumn(out, zscore_from(value, "_z", scale)).drop("_z_median", "_z_mad")


def rolling_minmax(
    df: DataFrame, *, k: int = 14, key: str = KEY, order: str = ORDER
) -> DataFrame:
    """Lowest low and highest high of the last ``k`` sessions."""
    frame = last_rows(df, key, order, k)
    return df.withColumns(
        {
            f"lowest_{k}": F.min("low_price").over(frame),
            f"highest_{k}": F.max("high_price").over(frame),
        }
    )


def slow_stochastic(
    df: DataFrame,
    *,
    k: int = 14,
    smooth_k: int = 3,
    smooth_d: int = 3,
    key: str = KEY,
    order: str = ORDER,
) -> DataFrame:
    """Position of the close inside the recent range (0..100), smoothed twice.

    Looks back ``k + smooth_k + smooth_d - 3`` rows.
    """
    low, high = f"lowest_{k}", f"highest_{k}"
    position = F.try_divide(F.col("close_price") - F.col(low), F.col(high) - F.col(low))
    return (
        rolling_minmax(df, k=k, key=key, order=order)
        .withColumn("fast_k", 100 * position)
        .withColumn("slow_k", F.avg("fast_k").over(last_rows(df, key, order, smooth_k)))
        .withColumn("slow_d", F.avg("slow_k").over(last_rows(df, key, order, smooth_d)))
        .drop(low, high)
    )


def average_distance(rows: int = 90) -> Column:
    """The close's relative distance from its moving average."""
    return F.try_divide("close_price", f"sma_{rows}") - 1


def moving_average(
    df: DataFrame, *, rows: int = 90, key: str = KEY, order: str = ORDER
) -> DataFrame:
    """Simple moving average of the close and the close's relative distance from it."""
    average = F.avg("close_price").over(last_rows(df, key, order, rows))
    return df.withColumn(f"sma_{rows}", average).withColumn(
        f"sma_{rows}_distance", average_distance(rows)
    )


def trend_lags(
    weeks: Iterable[int], months: Iterable[int], week_rows: int, month_rows: int
) -> dict[str, int]:
    """Flag name -> number of sessions it compares with."""
    by_weeks = {f"last_{n}_weeks_up": n * week_rows for n in weeks}
    by_months = {f"last_{n}_months_up": n * month_rows for n in months}
    return by_weeks | by_months


def trend_flags(
    df: DataFrame,
    *,
    weeks: Iterable[int] = range(2, 26, 2),
    months: Iterable[int] = range(2, 8, 2),
    week_rows: int = 5,
    month_rows: int = 21,
    key: str = KEY,
    order: str = ORDER,
) -> DataFrame:
    """1 when the close is above the close n weeks or months of sessions ago, 0 when not.

    Looks back as many rows as the largest of ``trend_lags``.
    """
    close, window = F.col("close_price"), series_window(df, key, order)
    lags = trend_lags(weeks, months, week_rows, month_rows)
    return df.withColumns(
        {flag: (close > F.lag(close, rows).over(window)).cast("int") for flag, rows in lags.items()}
    )


def volume_columns(rows: int, prefix: str) -> list[Column]:
    """Volume baselines and scores from the rolling median and MAD of the volume."""
    median, mad = F.col(f"{prefix}_median"), F.col(f"{prefix}_mad")
    return [
        F.log1p("total_volume").alias("log_volume"),
        median.alias(f"volume_median_{rows}"),
        F.try_divide("total_volume", median).alias("volume_ratio"),
        mad.alias(f"volume_mad_{rows}"),
        zscore_from("total_volume", prefix).alias(f"volume_zscore_{rows}"),
    ]


def volume_indicators(
    df: DataFrame, *, rows: int = 20, key: str = KEY, order: str = ORDER
) -> DataFrame:
    """Log volume, its ratio to the recent median, and its modified z-score."""
    measured = rolling_medians(df, [("total_volume", rows, "_volume")], key=key, order=order)
    return measured.select(*df.columns, *volume_columns(rows, "_volume"))


def signed_quantity() -> Column:
    """Quantity counted up on a rise, down on a fall, and not at all otherwise."""
    direction = F.coalesce(F.signum("log_return"), F.lit(0.0)).cast("long")
    return F.when(direction != 0, direction * F.col("total_quantity")).otherwise(0)


def obv(df: DataFrame, *, key: str = KEY, order: str = ORDER) -> DataFrame:
    """On-balance volume: running total of the signed quantity. Needs ``log_return``."""
    return running_sum(df, "obv", signed_quantity(), key=key, order=order)
