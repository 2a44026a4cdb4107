"""Cutting a long series into runs must not change any window result."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tableworks.operators import events as ev
from tableworks.operators import indicators as ind
from tableworks.operators.series import HALO, RUN, cut_series, settle
from tableworks.plans.stocks import stock_features

START = dt.date(2001, 1, 1)


def sessions(spark, seed=7, days=420):
    """One ticker with most of the rows, a sparse one and a short one."""
    rng = random.Random(seed)
    rows = []
    for ticker, share in (("HOT", 0.9), ("SPARSE", 0.15), ("SHORT", 0.02)):
        price = 20.0
        for day in range(days):
            if rng.random() > share:
                continue
            price = max(1.0, round(price * rng.choice([0.5, 0.98, 0.99, 1.0, 1.01, 1.02, 2.0]), 2))
            volume = None if rng.random() < 0.1 else float(rng.randint(0, 5)) * 100
            rows.append(
                (ticker, ticker[:3], START + dt.timedelta(days=day), price, price + 1, price - 0.5,
                 rng.randint(10, 99), rng.randint(1, 900), volume)
            )
    return spark.createDataFrame(
        rows,
        "ticker string, isin_code string, trade_date date, close_price double, "
        "high_price double, low_price double, total_trades long, total_quantity long, "
        "total_volume double",
    ).cache()


def rows_of(df):
    def plain(value):
        return round(value, 9) if isinstance(value, float) else value

    return sorted(
        (tuple(plain(value) for value in row) for row in df.collect()), key=repr
    )


# Name -> operator and the rows it looks back.
OPERATORS = {
    "log_return": (ind.log_return, 1),
    "zscore": (lambda df: ind.modified_zscore(df, value="close_price", out="z"), 89),
    "minmax": (ind.rolling_minmax, 13),
    "stochastic": (ind.slow_stochastic, 17),
    "average": (ind.moving_average, 89),
    "trend": (ind.trend_flags, 126),
    "sample": (lambda df: ind.rolling_sample(df, value="total_volume", rows=20, out="sample"), 19),
    "volume": (ind.volume_indicators, 19),
    "obv": (lambda df: ind.obv(ind.log_return(df)), 1),
    "lag": (lambda df: ev.lag_columns(df, columns={"before": "close_price"}), 1),
}


def cut(operator, df, rows, **more):
    return settle(operator(cut_series(df, lookback=rows, **more)))


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("run_rows", [1, 40])
def test_cut_series_give_the_same_rows(spark, name, run_rows):
    df = sessions(spark)
    operator, rows = OPERATORS[name]
    assert rows_of(cut(operator, df, rows, run_rows=run_rows)) == rows_of(operator(df))


@pytest.mark.parametrize("kind", ["int", "timestamp", "string"])
def test_any_order_type_and_tied_sizes(spark, kind):
    """Keys of equal size, a null key among them, ordered by other types than dates."""
    day = F.dayofyear("trade_date") + 1000 * F.year("trade_date")
    order = {"int": day, "timestamp": F.col("trade_date").cast("timestamp"), "string": F.col("trade_date").cast("string")}
    hot = sessions(spark).where("ticker = 'HOT'").withColumn("at", order[kind]).drop("trade_date")
    names = F.array(F.lit("A"), F.lit("B"), F.lit(None).cast("string"))
    df = hot.drop("ticker").withColumn("ticker", F.explode(names))

    def operator(rows):
        return ind.obv(ind.moving_average(ind.log_return(rows, order="at"), order="at"), order="at")

    assert rows_of(cut(operator, df, 90, order="at", run_rows=50)) == rows_of(operator(df))


def test_chained_operators_share_scan_and_shuffle(spark, tmp_path):
    sessions(spark).write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))

    def chain(rows):
        rows = ind.slow_stochastic(ind.obv(ind.log_return(rows)))
        return ind.trend_flags(ind.moving_average(rows))

    plan = chain(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "Broadcast" not in plan
    framed = cut_series(df, lookback=150, run_rows=40)
    assert rows_of(settle(chain(framed))) == rows_of(chain(df))


def test_long_series_are_really_cut_and_short_ones_are_not(spark):
    df = sessions(spark)
    framed = cut_series(df, lookback=5, run_rows=40)
    own = framed.where(~F.col(HALO))
    assert own.count() == df.count()
    sizes = {}
    for row in own.groupBy("ticker", RUN).count().collect():
        sizes.setdefault(row["ticker"], []).append(row["count"])
    # Ranges come from a sample, so runs are near their target, not at it.
    assert len(sizes["HOT"]) > 4 and max(map(max, sizes.values())) <= 3 * 40
    assert len(sizes["SHORT"]) <= 2


def test_halo_reaches_over_several_small_runs(spark):
    df = sessions(spark, seed=3, days=900).where(F.col("ticker") == "SPARSE")
    found = cut(lambda rows: ind.moving_average(rows, rows=30), df, 29, run_rows=1)
    assert rows_of(found) == rows_of(ind.moving_average(df, rows=30))


def test_rolling_median_and_mad_equal_brute_force(spark):
    df = sessions(spark)
    framed = cut_series(df, lookback=19, run_rows=40)
    got = settle(ind.rolling_median_mad(framed, value="total_volume", rows=20, prefix="v"))
    by_ticker = {}
    for row in df.orderBy("ticker", "trade_date").collect():
        by_ticker.setdefault(row["ticker"], []).append(row)
    expected = {}
    for ticker, rows in by_ticker.items():
        for index, row in enumerate(rows):
            frame = [r["total_volume"] for r in rows[max(0, index - 19) : index + 1]]
            frame = [value for value in frame if value is not None]
            center = statistics.median(frame) if frame else None
            mad = statistics.median(abs(v - center) for v in frame) if frame else None
            expected[ticker, row["trade_date"]] = (center, mad)
    assert {
        (row["ticker"], row["trade_date"]): (row["v_median"], row["v_mad"])
        for row in got.collect()
    } == expected


def test_small_arrow_batches_carry_series_over(spark):
    df = sessions(spark)
    whole = rows_of(ind.modified_zscore(df, value="close_price", out="z"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows_of(ind.modified_zscore(df, value="close_price", out="z")) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_zscore_ignores_scale(spark):
    df = sessions(spark)
    scaled = df.withColumn("close_price", F.col("close_price") * 1024)
    left = ind.modified_zscore(df, value="close_price", out="z").select("ticker", "trade_date", "z")
    right = ind.modified_zscore(scaled, value="close_price", out="z")
    assert rows_of(left) == rows_of(right.select("ticker", "trade_date", "z"))


def quotes(spark):
    return sessions(spark).select(
        "*",
        F.year("trade_date").alias("year"),
        F.lit("Company").alias("company_name"),
        F.lit("ON").alias("specification"),
        F.col("close_price").alias("open_price"),
        F.lit(1).cast("long").alias("quote_factor"),
        F.lit("010").alias("market_type"),
        F.lit("02").alias("bdi_code"),
    ).withColumn("total_volume", F.coalesce("total_volume", F.lit(0.0)))


def test_features_do_not_depend_on_cuts(spark):
    events = spark.createDataFrame(
        [("HOT", "DESDOBRAMENTO", 100.0, dt.date(2001, 6, 1))],
        "isin_code string, label string, factor double, last_date_prior date",
    )
    whole = stock_features(quotes(spark), events)
    cut = stock_features(quotes(spark), events, run_rows=60)
    assert rows_of(cut) == rows_of(whole)
    assert len(whole.columns) == 48
    assert whole.columns[:4] == ["isin_code", "trade_date", "year", "ticker"]
    assert whole.columns[-3:] == ["volume_mad_20", "volume_zscore_20", "obv"]
    types = dict(whole.dtypes)
    assert types["obv"] == types["total_quantity"] == "bigint"
    assert types["last_6_months_up"] == "int"


def test_first_session_and_constant_prices(spark):
    rows = [("T", START + dt.timedelta(days=n), 5.0, 5.0, 5.0, 10, 0.0) for n in range(4)]
    df = spark.createDataFrame(
        rows,
        "ticker string, trade_date date, close_price double, high_price double, "
        "low_price double, total_quantity long, total_volume double",
    )
    first, *rest = ind.obv(ind.log_return(df)).orderBy("trade_date").collect()
    assert first["log_return"] is None and first["obv"] == 0
    assert [row["obv"] for row in rest] == [0, 0, 0]
    scored = ind.modified_zscore(ind.log_return(df), value="log_return", out="z")
    assert {row["z"] for row in scored.collect()} == {None}
    stochastic = ind.slow_stochastic(df).collect()
    assert {row["fast_k"] for row in stochastic} == {None}
    volumes = ind.volume_indicators(df).collect()
    assert {row["volume_ratio"] for row in volumes} == {None}


def test_log_return_golden(spark):
    df = spark.createDataFrame(
        [("T", START, 9.31), ("T", START + dt.timedelta(days=1), 9.50)],
        "ticker string, trade_date date, close_price double",
    )
    second = ind.log_return(df).orderBy("trade_date").collect()[1]
    assert round(second["log_return"] * 100, 2) == 2.02
