"""Daily quotes to features per ticker and session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import events as ev
from ..operators import indicators as ind
from ..operators.quotes import filter_stocks, normalize_price
from ..operators.series import HALO, RUN, cut_series, rolling_medians, settle
from ..session import scratch, stored
from ..sources import tables

# Sessions behind the baselines of the return and volume scores, and the moving average.
RETURN_ROWS, VOLUME_ROWS, AVERAGE_ROWS = 90, 20, 90


def adjusted_prices(
    quotes: DataFrame,
    events: DataFrame,
    *,
    tolerance: float = 0.03,
    quantity_share: float = 0.5,
    min_trades: int = 10,
    min_price: float = 1.0,
    match_days: int = 5,
    store_events: bool = True,
) -> DataFrame:
    """Normalized quotes, back-adjusted for listed and inferred events.

    Events are few next to the quotes, but Spark cannot know it while they are a plan over
    the quotes. ``store_events`` writes their steps first: the join then sees their true
    size, broadcasts them only below the session's threshold and merges otherwise.
    """
    inferred = ev.inferred_events(
        quotes,
        tolerance=tolerance,
        quantity_share=quantity_share,
        min_trades=min_trades,
        min_price=min_price,
    )
    steps = ev.adjustment_steps(ev.all_events(ev.listed_events(events), inferred, match_days))
    if store_events:
        steps = stored(steps, "adjustment-steps")
    return ev.apply_steps(quotes, steps)


def stock_features(
    quotes: DataFrame,
    events: DataFrame,
    *,
    run_rows: int | None = None,
    return_rows: int = RETURN_ROWS,
    volume_rows: int = VOLUME_ROWS,
    average_rows: int = AVERAGE_ROWS,
    **thresholds,
) -> DataFrame:
    """The nine steps from raw quotes to 48 columns.

    All windows over a ticker share one shuffle and one sort. Columns that need no window come
    last, so that they do not pass through the stream of medians. ``run_rows`` cuts the series
    into runs, for tables where one ticker holds a large share of the rows. The return score
    looks back over returns, each of which looks back one more session; the halo covers the
    longest chain or flag.
    """
    priced = normalize_price(filter_stocks(quotes))
    series = adjusted_prices(priced, events, **thresholds)
    if run_rows is not None:
        lookback = sessions_behind(return_rows, volume_rows, average_rows)
        series = cut_series(series, lookback=lookback, run_rows=run_rows)
    measured = rolling_medians(
        frames(series, average_rows),
        median_frames(return_rows, volume_rows),
        key=ind.KEY,
        order=ind.ORDER,
    )
    shown = [name for name in series.columns if name not in (RUN, HALO)]
    if run_rows is not None:
        measured = settle(measured)
    return measured.select(*feature_columns(shown, volume_rows, average_rows))


def sessions_behind(
    return_rows: int = RETURN_ROWS, volume_rows: int = VOLUME_ROWS, average_rows: int = AVERAGE_ROWS
) -> int:
    """Sessions before a row that its features look back on, running totals aside."""
    lags = ind.trend_lags(range(2, 26, 2), range(2, 8, 2), week_rows=5, month_rows=21)
    return max(return_rows, volume_rows, average_rows, 20, *lags.values()) + 1


def frames(series: DataFrame, average_rows: int = AVERAGE_ROWS) -> DataFrame:
    """The columns that need a window but no median, over one shuffle and one sort."""
    framed = ind.slow_stochastic(ind.log_return(series))
    framed = ind.moving_average(framed, rows=average_rows).drop(f"sma_{average_rows}_distance")
    return ind.obv(ind.trend_flags(framed))


def median_frames(return_rows: int, volume_rows: int) -> list[tuple[str, int, str]]:
    return [("log_return", return_rows, "_return"), ("total_volume", volume_rows, "_volume")]


def feature_columns(
    shown: list[str], volume_rows: int = VOLUME_ROWS, average_rows: int = AVERAGE_ROWS
) -> list[Column | str]:
    """The features of a framed and measured series, those that need no window among them."""
    flags = ind.trend_lags(range(2, 26, 2), range(2, 8, 2), week_rows=5, month_rows=21)
    return [
        *shown,
        *[column.alias(name) for name, column in ind.log_columns().items()],
        "log_return",
        ind.zscore_from("log_return", "_return").alias("return_zscore"),
        "fast_k",
        "slow_k",
        "slow_d",
        f"sma_{average_rows}",
        ind.average_distance(average_rows).alias(f"sma_{average_rows}_distance"),
        *flags,
        *ind.volume_columns(volume_rows, "_volume"),
        "obv",
    ]


def run_stock_job(
    spark: SparkSession,
    source: str,
    target: str,
    events: str,
    features: str,
    *,
    fmt: str = "parquet",
    **thresholds,
) -> DataFrame:
    """Raw quotes to a table by year, once; then its features, replaced on every run."""
    raw = tables.scan_parquet(spark, source)
    tables.sink_if_absent(raw, target, ["year"], tables.year_of("trade_date"), fmt)
    quotes = tables.scan_table(spark, target, fmt)
    with scratch(spark):
        result = stock_features(quotes, tables.scan_parquet(spark, events), **thresholds)
        return tables.sink_overwrite(result, features, ["year"], fmt)
