import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tableworks.catalog import views
from tableworks.plans import daily
from tableworks.plans.stocks import stock_features
from tableworks.sources import versions

SMALL = "/root/testdata/sf0.001"
EVENTS = "isin_code string, label string, factor double, last_date_prior date"


@pytest.fixture(scope="module")
def quotes(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("quotes") / "q")
    views.bars(spark, SMALL).coalesce(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def days(quotes):
    newest = quotes.agg(F.max("trade_date")).first()[0]
    return [newest - timedelta(days=n) for n in (40, 20, 0)]


def upto(quotes, end):
    return quotes.where(F.col("trade_date") <= F.lit(end))


def rows(df):
    names = sorted(df.columns)
    shown = [F.round(c, 8).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)]
    return sorted(map(str, df.select(*shown).select(*names).collect()))


def none(spark):
    return spark.createDataFrame([], EVENTS)


def test_quiet_day_reads_state_and_the_day(spark, quotes, days, tmp_path):
    """``history`` that cannot be read is not missed where no price of the past changes."""
    root = str(tmp_path / "f")
    options = {"min_trades": 10**6}
    daily.advance(spark, root, upto(quotes, days[0]), none(spark), upto(quotes, days[0]), **options)
    state = versions.current_version(spark, root)
    assert spark.read.parquet(f"{state}/rows").groupBy("ticker").count().agg(F.max("count")).first()[0] <= 127
    fresh = quotes.where(F.col("trade_date") > F.lit(days[0]))
    lost = quotes.withColumn("ticker", F.raise_error(F.lit("history was read")).cast("string"))
    batch = daily.advance(spark, root, fresh, none(spark), lost, **options)
    want = stock_features(quotes, none(spark), **options)
    assert rows(batch) == rows(want.where(F.col("trade_date") > F.lit(days[0])))
    assert rows(daily.features(spark, root)) == rows(want)


def test_event_of_the_past_redoes_its_tickers_only(spark, quotes, days, tmp_path):
    root = str(tmp_path / "f")
    options = {"min_trades": 10**6}
    daily.advance(spark, root, upto(quotes, days[1]), none(spark), upto(quotes, days[1]), **options)
    isin = daily.features(spark, root).groupBy("isin_code").count().orderBy("isin_code").first()[0]
    events = spark.createDataFrame([(isin, "DESDOBRAMENTO", 100.0, days[0])], EVENTS)
    fresh = quotes.where(F.col("trade_date") > F.lit(days[1]))
    batch = daily.advance(spark, root, fresh, events, quotes, **options)
    old = batch.where(F.col("trade_date") <= F.lit(days[1]))
    assert [r[0] for r in old.select("isin_code").distinct().collect()] == [isin]
    assert rows(daily.features(spark, root)) == rows(stock_features(quotes, events, **options))


def test_late_quotes(spark, quotes, days, tmp_path):
    """Quotes of a past day, of a known and of an unknown series."""
    root = str(tmp_path / "f")
    first = daily_first(quotes)
    late = (F.col("isin_code") == first) & F.col("trade_date").between(*map(F.lit, (days[0] - timedelta(days=200), days[0])))
    unknown = F.col("isin_code") == daily_first(quotes.where(F.col("isin_code") != first))
    missing = late | unknown
    start = upto(quotes, days[1]).where(~missing)
    daily.advance(spark, root, start, views.corp_events(spark, SMALL), start, min_trades=1)
    fresh = quotes.where(missing | (F.col("trade_date") > F.lit(days[1])))
    daily.advance(spark, root, fresh, views.corp_events(spark, SMALL), quotes, min_trades=1)
    want = stock_features(quotes, views.corp_events(spark, SMALL), min_trades=1)
    assert rows(daily.features(spark, root)) == rows(want)


def daily_first(quotes):
    usable = quotes.where("market_type = '010' AND bdi_code = '02' AND specification IS NOT NULL")
    return usable.agg(F.min("isin_code")).first()[0]


def test_a_run_that_dies_can_be_repeated(spark, quotes, days, tmp_path, monkeypatch):
    root = str(tmp_path / "f")
    known = upto(quotes, days[1])
    daily.advance(spark, root, known, none(spark), known, min_trades=1)
    before, version = rows(daily.features(spark, root)), versions.current_version(spark, root)
    fresh = quotes.where(F.col("trade_date") > F.lit(days[1]))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(daily.versions, "point_to", dies)
        with pytest.raises(RuntimeError, match="lost"):
            daily.advance(spark, root, fresh, none(spark), quotes, min_trades=1)
    assert versions.current_version(spark, root) == version
    assert rows(daily.features(spark, root)) == before
    daily.advance(spark, root, fresh, none(spark), quotes, min_trades=1)
    assert rows(daily.features(spark, root)) == rows(stock_features(quotes, none(spark), min_trades=1))


def test_days_without_quotes(spark, quotes, tmp_path):
    root = str(tmp_path / "f")
    empty = quotes.limit(0)
    with pytest.raises(FileNotFoundError):
        daily.features(spark, root)
    daily.advance(spark, root, empty, none(spark), empty)
    daily.advance(spark, root, empty, none(spark), empty)
    assert daily.features(spark, root).isEmpty()
    daily.advance(spark, root, quotes, none(spark), quotes, min_trades=1)
    assert rows(daily.features(spark, root)) == rows(stock_features(quotes, none(spark), min_trades=1))
    assert os.path.isdir(f"{root}/features/batch=2")


def test_measured_rows_are_written_once(spark, quotes, days, tmp_path, monkeypatch):
    """Features are the only copy of the new rows, and states that nobody reads any more go."""
    root, names, keep = str(tmp_path / "f"), [], daily.stored
    monkeypatch.setattr(daily, "stored", lambda df, name: names.append((name, df.columns)) or keep(df, name))
    options, before = {"min_trades": 10**6}, None
    for end in days:
        known = upto(quotes, end)
        fresh = known if before is None else known.where(F.col("trade_date") > F.lit(before))
        daily.advance(spark, root, fresh, none(spark), known, **options)
        before = end
    assert not [name for name, columns in names if "obv" in columns]
    assert len(versions.versions(spark, root)) == 2
    assert rows(daily.features(spark, root)) == rows(stock_features(quotes, none(spark), **options))
