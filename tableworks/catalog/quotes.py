"""Quote, event and indicator queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import asof, audits, ranks
from ..operators import events as ev
from ..operators import indicators as ind
from ..operators import quotes as q
from ..operators.resample import resample_last as resample
from ..plans import daily
from ..plans.pipeline import Pipeline, Step, StoredPipeline
from ..plans.stocks import adjusted_prices
from ..plans.stocks import stock_features as features
from ..session import scratch, scratch_path, stored
from ..sources import tables
from . import views
from .registry import query, snap, snap_sql, snapped, snapped_sql

# The synthetic sessions have one or two trades each.
MIN_TRADES = 2

PRICED_SQL = f"""WITH {views.BARS_SQL}, {views.CORP_EVENTS_SQL},
stocks AS (
  SELECT trade_date, year, ticker, company_name, specification, isin_code, open_price,
         high_price, low_price, close_price, total_trades, total_quantity, total_volume,
         quote_factor
  FROM bars
  WHERE market_type = '010' AND bdi_code = '02' AND NOT contains(specification, 'DRN')
),
priced AS (
  SELECT * EXCLUDE (quote_factor)
           REPLACE (open_price / nullif(quote_factor, 0) AS open_price,
                    high_price / nullif(quote_factor, 0) AS high_price,
                    low_price / nullif(quote_factor, 0) AS low_price,
                    close_price / nullif(quote_factor, 0) AS close_price),
         close_price / nullif(quote_factor, 0) - open_price / nullif(quote_factor, 0)
           AS day_trade
  FROM stocks
),
listed AS (
  SELECT DISTINCT isin_code, last_date_prior,
         CASE WHEN label = 'GRUPAMENTO' THEN factor ELSE 1 + factor / 100 END AS multiplier,
         'b3' AS source
  FROM corp_events WHERE label IN ('DESDOBRAMENTO', 'BONIFICACAO', 'GRUPAMENTO')
),
paired AS (
  SELECT isin_code, trade_date, close_price, total_quantity, total_trades,
         lag(trade_date) OVER w AS last_date_prior, lag(close_price) OVER w AS close_before,
         lag(total_quantity) OVER w AS quantity_before, lag(total_trades) OVER w AS trades_before
  FROM priced WINDOW w AS (PARTITION BY isin_code ORDER BY trade_date)
),
ratios AS (
  SELECT unnest([1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 10.0, 20.0, 25.0, 50.0, 100.0, 1000.0])
         ::DOUBLE AS r
),
matched AS (
  SELECT p.*, (SELECT min(v) FROM (SELECT r AS v FROM ratios UNION ALL SELECT 1 / r FROM ratios)
               WHERE abs(ln(close_before / close_price / v)) <= 0.03) AS multiplier
  FROM paired p WHERE close_price > 0 AND close_before > 0
)"""


def inferred_sql(min_trades: int) -> str:
    return f"""
  SELECT isin_code, last_date_prior, multiplier, 'inferred' AS source FROM matched
  WHERE multiplier IS NOT NULL AND total_quantity > 0 AND quantity_before > 0
    AND sign(ln(total_quantity / quantity_before)) = sign(ln(multiplier))
    AND abs(ln(total_quantity / quantity_before)) >= 0.5 * abs(ln(multiplier))
    AND total_trades >= {min_trades} AND trades_before >= {min_trades}
    AND close_price >= 1.0 AND close_before >= 1.0"""


def all_events_sql(min_trades: int) -> str:
    return f"""
  SELECT * FROM listed
  UNION ALL
  SELECT * FROM ({inferred_sql(min_trades)}) i
  WHERE NOT EXISTS (
    SELECT 1 FROM listed l WHERE l.isin_code = i.isin_code
      AND abs(date_diff('day', i.last_date_prior, l.last_date_prior)) <= 5)"""


ADJUSTED_SQL = f"""{PRICED_SQL},
events_in_force AS ({all_events_sql(MIN_TRADES)}),
factors AS (
  SELECT p.isin_code, p.ticker, p.trade_date,
         CASE WHEN count(e.isin_code) = count(e.multiplier)
              THEN coalesce(product(e.multiplier), 1.0) ELSE 1.0 END AS adjustment
  FROM priced p LEFT JOIN events_in_force e
    ON e.isin_code = p.isin_code AND e.last_date_prior >= p.trade_date
  GROUP BY p.isin_code, p.ticker, p.trade_date
),
adjusted AS (
  SELECT p.isin_code, p.* EXCLUDE (isin_code)
           REPLACE (open_price / adjustment AS open_price,
                    high_price / adjustment AS high_price,
                    low_price / adjustment AS low_price,
                    close_price / adjustment AS close_price,
                    CAST(round(total_quantity * adjustment) AS BIGINT) AS total_quantity),
         adjustment
  FROM priced p JOIN factors USING (isin_code, ticker, trade_date)
)"""


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.normalize_price(q.filter_stocks(views.bars(spark, sf_dir)))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the indicator queries need of a session."""
    return priced(spark, sf_dir).select(
        "ticker", "trade_date", "high_price", "low_price", "close_price", "total_quantity",
        "total_volume",
    )


RETURN_SQL = """CASE WHEN close_price / nullif(lag(close_price) OVER w, 0) > 0
       THEN ln(close_price / nullif(lag(close_price) OVER w, 0)) END"""
BY_TICKER = "PARTITION BY ticker ORDER BY trade_date"


def frame_sql(rows: int) -> str:
    return f"({BY_TICKER} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


# --- filters and prices -----------------------------------------------------------------


@query(f"{PRICED_SQL} SELECT * FROM stocks")
def filter_stocks(spark, sf_dir):
    return q.filter_stocks(views.bars(spark, sf_dir))


@query(f"{PRICED_SQL} SELECT * FROM priced")
def normalize_price(spark, sf_dir):
    return priced(spark, sf_dir)


@query(
    f"""{PRICED_SQL} SELECT isin_code, trade_date, close_price FROM bars
    WHERE trade_date BETWEEN DATE '1998-03-01' AND DATE '1999-03-31'"""
)
def between_dates(spark, sf_dir):
    bars = views.bars(spark, sf_dir)
    return (
        bars.where(F.col("trade_date").between("1998-03-01", "1999-03-31"))
        .select("isin_code", "trade_date", "close_price")
        .orderBy("isin_code", "trade_date")
    )


LOGS = {f"log_{price}": 6 for price in ind.PRICES} | {"log_day_trade": 6}


@query(
    f"""{PRICED_SQL}, logs AS (
    SELECT ticker, trade_date, ln(1 + open_price) AS log_open_price,
           ln(1 + high_price) AS log_high_price, ln(1 + low_price) AS log_low_price,
           ln(1 + close_price) AS log_close_price,
           sign(day_trade) * ln(1 + abs(day_trade)) AS log_day_trade FROM priced)
    SELECT * REPLACE ({snapped_sql(LOGS)}) FROM logs"""
)
def log_features(spark, sf_dir):
    logs = ind.log_features(priced(spark, sf_dir)).select("ticker", "trade_date", *LOGS)
    return snapped(logs, LOGS)


# --- windows ----------------------------------------------------------------------------


@query(
    f"""{PRICED_SQL}
    SELECT isin_code, trade_date, lag(trade_date) OVER w AS last_date_prior,
           lag(close_price) OVER w AS close_before, lag(total_quantity) OVER w AS quantity_before,
           lag(total_trades) OVER w AS trades_before
    FROM priced WINDOW w AS (PARTITION BY isin_code ORDER BY trade_date)"""
)
def lag_columns(spark, sf_dir):
    quotes = priced(spark, sf_dir).select(
        "isin_code", "trade_date", "close_price", "total_quantity", "total_trades"
    )
    paired = ev.lag_columns(
        quotes,
        key="isin_code",
        columns={
            "last_date_prior": "trade_date",
            "close_before": "close_price",
            "quantity_before": "total_quantity",
            "trades_before": "total_trades",
        },
    )
    return paired.drop("close_price", "total_quantity", "total_trades")


@query(
    f"""{PRICED_SQL}, returns AS (
    SELECT ticker, trade_date, {RETURN_SQL} AS log_return FROM priced WINDOW w AS ({BY_TICKER}))
    SELECT * REPLACE ({snapped_sql({"log_return": 6})}) FROM returns"""
)
def log_return(spark, sf_dir):
    returns = ind.log_return(sessions(spark, sf_dir))
    return snapped(returns.select("ticker", "trade_date", "log_return"), {"log_return": 6})


def zscore_sql(value: str, median: str, mad: str) -> str:
    return f"CASE WHEN {mad} > 0 THEN 0.6745 * ({value} - {median}) / {mad} END"


def samples_sql(value: str, rows: int, source: str) -> str:
    """CTEs s (sample list), m (its median) and d (its MAD) over ``source``."""
    return f"""
s AS (SELECT *, list({value}) FILTER (WHERE {value} IS NOT NULL) OVER {frame_sql(rows)} AS sample
      FROM {source}),
m AS (SELECT *, list_median(sample) AS median FROM s),
d AS (SELECT * EXCLUDE (sample), list_median(list_transform(sample, lambda v: abs(v - median)))
             AS mad FROM m)"""


RETURNS_SQL = f"""{PRICED_SQL}, returns AS (
  SELECT ticker, trade_date, total_volume, total_quantity, {RETURN_SQL} AS log_return
  FROM priced WINDOW w AS ({BY_TICKER}))"""


@query(
    f"""{RETURNS_SQL}, {samples_sql("log_return", 90, "returns")}
    SELECT ticker, trade_date,
           {snap_sql(zscore_sql("log_return", "median", "mad"), 5)} AS return_zscore FROM d"""
)
def modified_zscore_return(spark, sf_dir):
    # Two chained frames: each row of the second needs a return, which needs one row more.
    returns = ind.log_return(sessions(spark, sf_dir)).select("ticker", "trade_date", "log_return")
    scored = ind.modified_zscore(returns, value="log_return", out="return_zscore")
    return snapped(scored.drop("log_return"), {"return_zscore": 5})


@query(
    f"""{PRICED_SQL} SELECT ticker, trade_date, min(low_price) OVER w AS lowest_14,
    max(high_price) OVER w AS highest_14 FROM priced WINDOW w AS {frame_sql(14)}"""
)
def rolling_minmax(spark, sf_dir):
    banded = ind.rolling_minmax(sessions(spark, sf_dir))
    return banded.select("ticker", "trade_date", "lowest_14", "highest_14")


STOCHASTIC = {"fast_k": 5, "slow_k": 5, "slow_d": 5}


def stochastic_sql(source: str) -> str:
    return f"""
band AS (SELECT *, min(low_price) OVER w AS low14, max(high_price) OVER w AS high14
         FROM {source} WINDOW w AS {frame_sql(14)}),
fast AS (SELECT * EXCLUDE (low14, high14),
                100 * ((close_price - low14) / nullif(high14 - low14, 0)) AS fast_k FROM band),
slow AS (SELECT *, avg(fast_k) OVER {frame_sql(3)} AS slow_k FROM fast),
stochastic AS (SELECT *, avg(slow_k) OVER {frame_sql(3)} AS slow_d FROM slow)"""


@query(
    f"""{PRICED_SQL}, {stochastic_sql("priced")}
    SELECT ticker, trade_date, {snapped_sql(STOCHASTIC)} FROM stochastic"""
)
def slow_stochastic(spark, sf_dir):
    positions = ind.slow_stochastic(sessions(spark, sf_dir))
    return snapped(positions.select("ticker", "trade_date", *STOCHASTIC), STOCHASTIC)


AVERAGES = {"sma_90": 6, "sma_90_distance": 6}


def averages_sql(source: str) -> str:
    return f"""
averages AS (SELECT *, avg(close_price) OVER {frame_sql(90)} AS sma_90 FROM {source}),
distances AS (SELECT *, close_price / nullif(sma_90, 0) - 1 AS sma_90_distance FROM averages)"""


@query(
    f"""{PRICED_SQL}, {averages_sql("priced")}
    SELECT ticker, trade_date, {snapped_sql(AVERAGES)} FROM distances"""
)
def moving_average(spark, sf_dir):
    averages = ind.moving_average(sessions(spark, sf_dir))
    return snapped(averages.select("ticker", "trade_date", *AVERAGES), AVERAGES)


TREND_LAGS = ind.trend_lags(range(2, 26, 2), range(2, 8, 2), 5, 21)
TREND_SQL = ", ".join(
    f"CAST(close_price > lag(close_price, {rows}) OVER w AS INTEGER) AS {flag}"
    for flag, rows in TREND_LAGS.items()
)


@query(
    f"""{PRICED_SQL} SELECT ticker, trade_date, {TREND_SQL}
    FROM priced WINDOW w AS ({BY_TICKER})"""
)
def trend_flags(spark, sf_dir):
    flagged = ind.trend_flags(sessions(spark, sf_dir))
    return flagged.select("ticker", "trade_date", *TREND_LAGS)


@query(
    f"""{RETURNS_SQL}, {samples_sql("log_return", 20, "returns")}
    SELECT ticker, trade_date, CAST(coalesce(len(sample), 0) AS INTEGER) AS sample_size,
      coalesce(array_to_string(list_transform(sample,
        lambda v: CAST(floor(v * 1000000 + 0.3711) AS BIGINT)), ','), '') AS sample
    FROM s"""
)
def rolling_collect(spark, sf_dir):
    returns = ind.log_return(sessions(spark, sf_dir))
    sampled = ind.rolling_sample(returns, value="log_return", rows=20, out="sample")
    millionths = F.transform("sample", lambda v: F.floor(v * 1_000_000.0 + 0.3711).cast("string"))
    return sampled.select(
        "ticker",
        "trade_date",
        F.size("sample").alias("sample_size"),
        F.array_join(millionths, ",").alias("sample"),
    )


@query(
    f"""{RETURNS_SQL}, {samples_sql("total_volume", 20, "returns")}
    SELECT ticker, trade_date, {snap_sql("median", 4)} AS volume_median,
           {snap_sql("mad", 4)} AS volume_mad FROM d"""
)
def rolling_median_mad(spark, sf_dir):
    measured = ind.rolling_median_mad(
        sessions(spark, sf_dir), value="total_volume", rows=20, prefix="volume"
    ).select("ticker", "trade_date", "volume_median", "volume_mad")
    return snapped(measured, {"volume_median": 4, "volume_mad": 4})


@query(
    f"""{RETURNS_SQL}, {samples_sql("total_volume", 500, "returns")}
    SELECT ticker, trade_date, {snap_sql("median", 4)} AS volume_median,
           {snap_sql("mad", 4)} AS volume_mad FROM d"""
)
def rolling_median_wide(spark, sf_dir):
    """Frames of 500 sessions, searched by ranks."""
    measured = ind.rolling_median_mad(
        sessions(spark, sf_dir), value="total_volume", rows=500, prefix="volume"
    ).select("ticker", "trade_date", "volume_median", "volume_mad")
    return snapped(measured, {"volume_median": 4, "volume_mad": 4})


VOLUME = {
    "log_volume": 6,
    "volume_median_20": 4,
    "volume_ratio": 6,
    "volume_mad_20": 4,
    "volume_zscore_20": 5,
}


def volume_sql(source: str) -> str:
    return f"""{samples_sql("total_volume", 20, source)},
volumes AS (
  SELECT * EXCLUDE (median, mad), ln(1 + total_volume) AS log_volume,
         median AS volume_median_20, total_volume / nullif(median, 0) AS volume_ratio,
         mad AS volume_mad_20, {zscore_sql("total_volume", "median", "mad")} AS volume_zscore_20
  FROM d)"""


@query(
    f"""{RETURNS_SQL}, {volume_sql("returns")}
    SELECT ticker, trade_date, {snapped_sql(VOLUME)} FROM volumes"""
)
def volume_indicators(spark, sf_dir):
    volumes = ind.volume_indicators(sessions(spark, sf_dir))
    return snapped(volumes.select("ticker", "trade_date", *VOLUME), VOLUME)


OBV_SQL = f"""CAST(sum(CASE WHEN log_return > 0 THEN total_quantity
    WHEN log_return < 0 THEN -total_quantity ELSE 0 END) OVER ({BY_TICKER}) AS BIGINT)"""


@query(f"{RETURNS_SQL} SELECT ticker, trade_date, {OBV_SQL} AS obv FROM returns")
def obv(spark, sf_dir):
    returns = ind.log_return(sessions(spark, sf_dir))
    return ind.obv(returns).select("ticker", "trade_date", "obv")


# --- events -----------------------------------------------------------------------------


@query(
    f"""{PRICED_SQL} SELECT * FROM corp_events
    WHERE label IN ('DESDOBRAMENTO', 'BONIFICACAO', 'GRUPAMENTO')"""
)
def isin_filter(spark, sf_dir):
    labels = F.col("label").isin(*ev.MULTIPLIERS)
    return views.corp_events(spark, sf_dir).where(labels)


@query(f"{PRICED_SQL} SELECT * REPLACE ({snapped_sql({'multiplier': 6})}) FROM listed")
def listed_events(spark, sf_dir):
    return snapped(ev.listed_events(views.corp_events(spark, sf_dir)), {"multiplier": 6})


@query(
    f"""{PRICED_SQL} SELECT * REPLACE ({snapped_sql({'multiplier': 6})})
    FROM ({inferred_sql(1)})"""
)
def inferred_events(spark, sf_dir):
    inferred = ev.inferred_events(priced(spark, sf_dir), min_trades=1)
    return snapped(inferred, {"multiplier": 6})


@query(
    f"""{PRICED_SQL} SELECT isin_code, last_date_prior, {snap_sql('multiplier')} AS multiplier,
    source FROM ({inferred_sql(1)}) i
    WHERE NOT EXISTS (SELECT 1 FROM listed l WHERE l.isin_code = i.isin_code
      AND abs(date_diff('day', i.last_date_prior, l.last_date_prior)) <= 5)"""
)
def anti_join_nearby(spark, sf_dir):
    inferred = ev.inferred_events(priced(spark, sf_dir), min_trades=1)
    listed = ev.listed_events(views.corp_events(spark, sf_dir))
    return snapped(ev.anti_join_nearby(inferred, listed), {"multiplier": 6})


def events_in_force(spark, sf_dir, min_trades: int) -> DataFrame:
    inferred = ev.inferred_events(priced(spark, sf_dir), min_trades=min_trades)
    return ev.all_events(ev.listed_events(views.corp_events(spark, sf_dir)), inferred)


@query(
    f"""{PRICED_SQL} SELECT * REPLACE ({snapped_sql({'multiplier': 6})})
    FROM ({all_events_sql(1)})"""
)
def all_events(spark, sf_dir):
    return snapped(events_in_force(spark, sf_dir, 1), {"multiplier": 6})


@query(
    f"""{PRICED_SQL} SELECT isin_code, last_date_prior, multiplier, source FROM listed
    UNION ALL SELECT isin_code, last_date_prior, multiplier, source FROM ({inferred_sql(1)})""",
)
def union_by_name(spark, sf_dir):
    listed = ev.listed_events(views.corp_events(spark, sf_dir))
    inferred = ev.inferred_events(priced(spark, sf_dir), min_trades=1)
    shuffled = inferred.select("source", "multiplier", "last_date_prior", "isin_code")
    return listed.unionByName(shuffled)


EVENT_SQL = """coalesce(strftime(last_date_prior, '%Y-%m-%d'), '') || ':'
  || coalesce(CAST(CAST(floor(multiplier * 1000000 + 0.3711) AS BIGINT) AS VARCHAR), '')"""


@query(
    f"""{PRICED_SQL} SELECT isin_code, count(*) AS n_events,
      string_agg({EVENT_SQL}, ',' ORDER BY last_date_prior NULLS FIRST, multiplier NULLS FIRST)
        AS events
    FROM ({all_events_sql(1)}) GROUP BY isin_code"""
)
def collect_events(spark, sf_dir):
    collected = ev.collect_events(events_in_force(spark, sf_dir, 1))
    entry = F.transform(
        "events",
        lambda e: F.concat(
            F.coalesce(F.date_format(e["last_date_prior"], "yyyy-MM-dd"), F.lit("")),
            F.lit(":"),
            F.coalesce(F.floor(e["multiplier"] * 1_000_000.0 + 0.3711).cast("string"), F.lit("")),
        ),
    )
    return collected.select(
        "isin_code",
        F.size("events").cast("long").alias("n_events"),
        F.array_join(entry, ",").alias("events"),
    )


ADJUSTED = {price: 6 for price in ind.PRICES} | {"adjustment": 7, "day_trade": 6}


@query(f"{ADJUSTED_SQL} SELECT * REPLACE ({snapped_sql(ADJUSTED)}) FROM adjusted")
def back_adjust(spark, sf_dir):
    events = events_in_force(spark, sf_dir, MIN_TRADES)
    return snapped(ev.back_adjust(priced(spark, sf_dir), events), ADJUSTED)


@query(f"{ADJUSTED_SQL} SELECT * REPLACE ({snapped_sql(ADJUSTED)}) FROM adjusted")
def back_adjust_asof(spark, sf_dir):
    # Quotes are read for the events, too, and listed events twice: each is made once.
    quotes = ranks.numbered_rows(priced(spark, sf_dir), "_number")
    listed = stored(ev.listed_events(views.corp_events(spark, sf_dir)), "listed")
    events = ev.all_events(listed, ev.inferred_events(quotes, min_trades=MIN_TRADES))
    return snapped(ev.back_adjust_asof(quotes, events, number="_number"), ADJUSTED)


LISTED_ON_SQL = "SELECT isin_code, last_date_prior, max(multiplier) AS multiplier FROM listed GROUP BY ALL"


@query(
    f"""{PRICED_SQL} SELECT p.ticker, p.trade_date, p.close_price, e.last_date_prior,
      {snap_sql('e.multiplier')} AS multiplier
    FROM priced p ASOF LEFT JOIN ({LISTED_ON_SQL}) e
      ON p.isin_code = e.isin_code AND p.trade_date > e.last_date_prior"""
)
def asof_join(spark, sf_dir):
    """Each session with the last published event before it."""
    listed = ev.listed_events(views.corp_events(spark, sf_dir)).withColumn("day", F.col("last_date_prior"))
    found = asof.asof_join(
        priced(spark, sf_dir), listed, by=["isin_code"], on=("trade_date", "day"),
        values=["last_date_prior", "multiplier"], strict=True,
    )
    shown = found.select("ticker", "trade_date", "close_price", "last_date_prior", "multiplier")
    return snapped(shown, {"multiplier": 6})


# The same result through stored steps, whose true size decides between broadcast and merge.
@query(f"{ADJUSTED_SQL} SELECT * REPLACE ({snapped_sql(ADJUSTED)}) FROM adjusted")
def join_broadcast_left(spark, sf_dir):
    adjusted = adjusted_prices(
        priced(spark, sf_dir), views.corp_events(spark, sf_dir), min_trades=MIN_TRADES
    )
    return snapped(adjusted, ADJUSTED)


# --- composites -------------------------------------------------------------------------

FEATURES = (
    ADJUSTED
    | LOGS
    | {"log_return": 6, "return_zscore": 5}
    | STOCHASTIC
    | AVERAGES
    | VOLUME
)
FEATURES_SQL = f"""{ADJUSTED_SQL},
logs AS (
  SELECT *, ln(1 + open_price) AS log_open_price, ln(1 + high_price) AS log_high_price,
         ln(1 + low_price) AS log_low_price, ln(1 + close_price) AS log_close_price,
         sign(day_trade) * ln(1 + abs(day_trade)) AS log_day_trade,
         {RETURN_SQL} AS log_return
  FROM adjusted WINDOW w AS ({BY_TICKER})),
rs AS (SELECT *, list(log_return) FILTER (WHERE log_return IS NOT NULL) OVER {frame_sql(90)}
              AS r_sample FROM logs),
rm AS (SELECT *, list_median(r_sample) AS r_median FROM rs),
rd AS (SELECT *, list_median(list_transform(r_sample, lambda v: abs(v - r_median))) AS r_mad
       FROM rm),
scored AS (SELECT * EXCLUDE (r_sample, r_median, r_mad),
                  {zscore_sql("log_return", "r_median", "r_mad")} AS return_zscore FROM rd),
{stochastic_sql("scored")}, {averages_sql("stochastic")},
trends AS (SELECT *, {TREND_SQL} FROM distances WINDOW w AS ({BY_TICKER})),
{volume_sql("trends")},
features AS (SELECT *, {OBV_SQL} AS obv FROM volumes)
SELECT * REPLACE ({snapped_sql(FEATURES)}) FROM features"""


@query(FEATURES_SQL)
def stock_features(spark, sf_dir):
    """The flagship: nine steps from raw quotes to 48 columns."""
    quotes = stored(views.bars(spark, sf_dir, in_order=True), "quotes")
    events = views.corp_events(spark, sf_dir)
    return snapped(features(quotes, events, min_trades=MIN_TRADES), FEATURES)


@query(FEATURES_SQL)
def stock_features_bucketed(spark, sf_dir):
    """The same over quotes stored by ticker: no shuffle for its windows."""
    path = scratch_path(spark, "quotes-by-ticker")
    table = "quotes_" + path.rsplit("-", 1)[-1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with scratch(spark):
        bars = stored(views.bars(spark, sf_dir, in_order=True), "quotes")
        quotes = tables.sink_bucketed(bars, table, path, "ticker", "trade_date", buckets)
    return snapped(features(quotes, views.corp_events(spark, sf_dir), min_trades=MIN_TRADES), FEATURES)


@query(FEATURES_SQL)
def stock_features_daily(spark, sf_dir):
    """The same rows from three runs, each from the state of the one before and new sessions."""
    root = scratch_path(spark, "daily-features")
    quotes = stored(views.bars(spark, sf_dir, in_order=True), "quotes")
    events = views.corp_events(spark, sf_dir)
    newest = quotes.agg(F.max("trade_date")).first()[0]
    ends = [newest - timedelta(days=days) for days in (60, 30, 0)]
    before = None
    for end in ends:
        known = quotes.where(F.col("trade_date") <= F.lit(end))
        fresh = known if before is None else known.where(F.col("trade_date") > F.lit(before))
        daily.advance(spark, root, fresh, events, known, min_trades=MIN_TRADES)
        before = end
    return snapped(daily.features(spark, root), FEATURES)


class _Apply(Step):
    def __init__(self, function):
        self.function = function

    def run(self, df):
        return self.function(df)

    def settings(self):
        return {"function": f"{self.function.__module__}.{self.function.__qualname__}"}


CHAIN_SQL = f"""{PRICED_SQL}, returns AS (
    SELECT *, {RETURN_SQL} AS log_return FROM priced WINDOW w AS ({BY_TICKER})),
    {averages_sql("returns")}
    SELECT * REPLACE ({snapped_sql({"log_return": 6, "day_trade": 4} | AVERAGES)})
    FROM distances"""
CHAIN = [_Apply(step) for step in (q.filter_stocks, q.normalize_price, ind.log_return, ind.moving_average)]


@query(CHAIN_SQL)
def pipeline_chain(spark, sf_dir):
    chained = Pipeline(CHAIN).run(views.bars(spark, sf_dir))
    return snapped(chained, {"log_return": 6, "day_trade": 4} | AVERAGES)


@query(CHAIN_SQL)
def pipeline_stored(spark, sf_dir):
    """A run of two steps, and one of all four that goes on where it ended."""
    root, quotes = scratch_path(spark, "steps"), views.bars(spark, sf_dir)
    StoredPipeline(CHAIN[:2], root, sf_dir).run(quotes)
    chained = StoredPipeline(CHAIN, root, sf_dir).run(quotes)
    return snapped(chained, {"log_return": 6, "day_trade": 4} | AVERAGES)


# --- counts and resampling over quotes --------------------------------------------------


@query(f"{PRICED_SQL} SELECT year, count(*) AS rows FROM bars GROUP BY year")
def count_by_year(spark, sf_dir):
    return audits.count_by_year(views.bars(spark, sf_dir), "trade_date")


WEEKLY = ["close_price", "total_quantity", "day_trade", "log_return"]
LAST_SQL = ", ".join(f"arg_max({c}, trade_date) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in WEEKLY)


def resample_sql(period: str) -> str:
    return f"""{PRICED_SQL}, returns AS (
    SELECT ticker, trade_date, close_price, total_quantity, day_trade,
           {RETURN_SQL} AS log_return FROM priced WINDOW w AS ({BY_TICKER})),
    lasts AS (SELECT ticker, {period} AS period, {LAST_SQL} FROM returns GROUP BY 1, 2)
    SELECT * REPLACE ({snapped_sql({"day_trade": 4, "log_return": 6})}) FROM lasts"""


def _resampled(spark, sf_dir, freq):
    returns = ind.log_return(priced(spark, sf_dir)).select("ticker", "trade_date", *WEEKLY)
    lasts = resample(returns, "ticker", "trade_date", freq)
    return snapped(lasts, {"day_trade": 4, "log_return": 6})


# isodow is 7 on Sunday, so the label is the Sunday on or after the session.
@query(resample_sql("CAST(trade_date + to_days(CAST(7 - isodow(trade_date) AS INTEGER)) AS DATE)"))
def resample_last(spark, sf_dir):
    return _resampled(spark, sf_dir, "W")


@query(resample_sql("last_day(trade_date)"))
def resample_last_month(spark, sf_dir):
    return _resampled(spark, sf_dir, "ME")


@query(
    f"""{PRICED_SQL} SELECT ticker, trade_date, close_price,
    {snap_sql("day_trade", 4)} AS day_trade FROM priced"""
)
def order_by(spark, sf_dir):
    ordered = priced(spark, sf_dir).select(
        "ticker", "trade_date", "close_price", snap("day_trade", 4).alias("day_trade")
    )
    return ordered.orderBy(F.desc(F.abs("day_trade")), "ticker", "trade_date")
