"""Stock features day by day: new sessions are added from what the last run left behind.

A run keeps, per ticker, the adjusted rows that later frames can look back on and the running
volume total they start from; per ISIN, its last quote; and the events and adjustment steps in force.
The next run reads these and the new sessions and nothing else. An event that changes the adjustment
of sessions already written, or a quote that comes late, marks the tickers it concerns: they alone are
computed again from their whole history, and their new rows stand in for the old ones.

A run writes beside the state of the one before and takes effect when it is published, so a run that
dies leaves everything as it was and can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import events as ev
from ..operators import indicators as ind
from ..operators.quotes import filter_stocks, normalize_price
from ..operators.series import rolling_medians, series_window
from ..session import scratch, shuffles_freed, stored
from ..sources import versions
from . import stocks

CARRIED, FRESH = "_carried", "_fresh"
BATCH = "batch"
STATE = ("rows", "steps", "inferred", "last", "pairs", "redone", "meta")
_LAST = ("isin_code", "trade_date", "close_price", "total_quantity", "total_trades")
_STEP = ("isin_code", "bucket_year", "after", "until", "adjustment")


def _read(spark: SparkSession, version: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{version}/{name}")


def _schema(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])


def _past(steps: DataFrame, as_of) -> DataFrame:
    """Steps as far as they concern sessions up to a date."""
    end = F.lit(as_of)
    return (
        steps.where(F.col("after").isNull() | (F.col("after") < end))
        .where(F.col("bucket_year") <= F.greatest(F.year(end), F.lit(ev.FIRST_YEAR)))
        .select("isin_code", "bucket_year", "after", F.least("until", end).alias("until"), "adjustment")
    )


def _measured(series: DataFrame) -> DataFrame:
    """Frames and medians over state and new rows; running totals go on from the carried ones."""
    start = F.first(CARRIED).over(series_window(series, ind.KEY, ind.ORDER))
    framed = stocks.frames(series).withColumn("obv", F.col("obv") + F.coalesce(start, F.lit(0)))
    medians = stocks.median_frames(stocks.RETURN_ROWS, stocks.VOLUME_ROWS)
    return rolling_medians(framed, medians, key=ind.KEY, order=ind.ORDER)


def _last_rows(df: DataFrame, key: str, rows: int) -> DataFrame:
    latest = Window.partitionBy(key).orderBy(F.desc("trade_date"))
    return df.withColumn("_age", F.row_number().over(latest)).where(F.col("_age") <= rows).drop("_age")


def advance(
    spark: SparkSession,
    root: str,
    fresh: DataFrame,
    events: DataFrame,
    history: DataFrame,
    *,
    match_days: int = 5,
    **thresholds,
) -> DataFrame:
    """Add the sessions of ``fresh`` to the features below ``root``; returns the batch it wrote.

    ``fresh`` holds raw quotes not added before, ``events`` every published event known now, and
    ``history`` all raw quotes, ``fresh`` among them. ``history`` is read in the first run and for
    tickers that have to be computed again, else not at all. Quotes are unique per ISIN and date.
    """
    with scratch(spark):
        version = versions.current_version(spark, root)
        state = {name: _read(spark, version, name) for name in STATE} if version else None
        as_of, batch = state["meta"].first() if state else (None, -1)
        batch += 1
        quotes = history if state is None else fresh
        priced = normalize_price(filter_stocks(quotes))
        if state:
            # The first run's are the history, which is read as it is.
            priced = stored(priced, "fresh-quotes")
        known = priced.select(*_LAST)
        met = known if state is None else state["last"].unionByName(known)
        inferred = ev.inferred_events(met, **thresholds)
        if state:
            inferred = state["inferred"].unionByName(inferred)
            late = stored(
                priced.where(F.col("trade_date") <= F.lit(as_of)).select("isin_code").distinct(), "late"
            )
            if not late.isEmpty():
                # Among the sessions it came late to, a quote makes and unmakes pairs.
                again = normalize_price(filter_stocks(history)).join(late, "isin_code", "left_semi")
                met = met.join(late, "isin_code", "left_anti").unionByName(again.select(*_LAST))
                inferred = inferred.join(late, "isin_code", "left_anti").unionByName(
                    ev.inferred_events(again, **thresholds)
                )
        inferred = stored(inferred, "inferred")
        listed = ev.listed_events(events)
        steps = stored(ev.adjustment_steps(ev.all_events(listed, inferred, match_days)), "steps")
        pairs = priced.select("ticker", "isin_code").distinct()
        redo = None
        if state:
            pairs = state["pairs"].unionByName(pairs).distinct()
            redo = stored(_to_redo(state, steps, pairs, late, as_of), "redo")
        made = _batch(spark, state, priced, steps, redo, history)

        shown = [name for name in made.columns if name in _series_columns(priced)]
        target = f"{root}/features/{BATCH}={batch}"
        features = made.where(FRESH).select(*stocks.feature_columns(shown))
        with shuffles_freed(spark):
            features.write.mode("overwrite").option("compression", "zstd").parquet(target)

        # The features hold all that the next run has to know of new rows; old ones stay as they are.
        version = versions.new_version(root)
        written = spark.read.schema(_schema(features)).parquet(target)
        kept = written.select(*shown, F.col("obv").alias(CARRIED))
        if state:
            behind = state["rows"].join(redo, ind.KEY, "left_anti")
            kept = kept.unionByName(behind.select(*shown, CARRIED))
        kept = _last_rows(kept, ind.KEY, stocks.sessions_behind())
        with shuffles_freed(spark):
            kept.write.option("compression", "zstd").parquet(f"{version}/rows")
        steps.write.parquet(f"{version}/steps")
        inferred.write.parquet(f"{version}/inferred")
        _last_rows(met, "isin_code", 1).write.parquet(f"{version}/last")
        pairs.write.parquet(f"{version}/pairs")
        redone = spark.createDataFrame([], f"ticker string, {BATCH} int")
        if state:
            marked = redo.select("ticker", F.lit(batch).alias(BATCH))
            redone = state["redone"].unionByName(marked).groupBy("ticker").agg(F.max(BATCH).alias(BATCH))
        redone.write.parquet(f"{version}/redone")
        newest = met.agg(F.max("trade_date").alias("as_of"), F.lit(batch).alias(BATCH))
        newest.write.parquet(f"{version}/meta")
        versions.point_to(spark, root, version)
        # The state of the last run stays for those who read it now.
        versions.drop_versions(spark, root, keep=2)
    return spark.read.schema(_schema(features)).parquet(target)


def _series_columns(priced: DataFrame) -> list[str]:
    return [*priced.columns, "adjustment"]


def _to_redo(state, steps: DataFrame, pairs: DataFrame, late: DataFrame, as_of) -> DataFrame:
    """Tickers with a session, already written, that a changed step or a late quote concerns."""
    old, new = _past(state["steps"].select(*_STEP), as_of), _past(steps.select(*_STEP), as_of)
    changed = old.exceptAll(new).unionByName(new.exceptAll(old))
    concerned = state["pairs"].join(changed, "isin_code", "left_semi")
    return concerned.unionByName(pairs.join(late, "isin_code", "left_semi")).select("ticker").distinct()


def _batch(spark, state, priced: DataFrame, steps: DataFrame, redo, history: DataFrame) -> DataFrame:
    """Measured rows; ``_fresh`` marks those that this batch adds or replaces."""

    def adjusted(quotes: DataFrame, carried: Column, fresh: bool) -> DataFrame:
        return ev.apply_steps(quotes, steps).withColumns({CARRIED: carried, FRESH: F.lit(fresh)})

    none = F.lit(None).cast("long")
    if state is None:
        return _measured(adjusted(priced, none, True))
    added = adjusted(priced.join(redo, ind.KEY, "left_anti"), none, True)
    behind = state["rows"].join(redo, ind.KEY, "left_anti").withColumn(FRESH, F.lit(False))
    made = _measured(behind.unionByName(added))
    if redo.isEmpty():
        return made
    whole = normalize_price(filter_stocks(history)).join(redo, ind.KEY, "left_semi")
    return made.unionByName(_measured(adjusted(whole, none, True)))


def features(spark: SparkSession, root: str) -> DataFrame:
    """The features of all published batches, replaced rows left out."""
    version = versions.current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no features at {root}")
    last = _read(spark, version, "meta").first()[BATCH]
    redone = _read(spark, version, "redone").withColumnsRenamed({"ticker": "_ticker", BATCH: "_batch"})
    every = spark.read.parquet(f"{root}/features").where(F.col(BATCH) <= last)
    replaced = (F.col("ticker") == F.col("_ticker")) & (F.col(BATCH) < F.col("_batch"))
    return every.join(redone, replaced, "left_anti").drop(BATCH)
