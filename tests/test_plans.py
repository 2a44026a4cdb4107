"""Pipeline behaviour, session settings, and the shape of physical plans."""

import logging
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tableworks import session
from tableworks.catalog import views
from tableworks.operators import events as ev
from tableworks.operators import indicators as ind
from tableworks.operators.quotes import filter_stocks, normalize_price
from tableworks.operators.series import rolling_medians
from tableworks.plans.pipeline import Pipeline, Step
from tableworks.plans.stocks import run_stock_job, stock_features
from tableworks.sources import tables

SMALL = "/root/testdata/sf0.001"


class AddOne(Step):
    def run(self, df):
        return df.withColumn("id", F.col("id") + 1)


class Start(Step):
    def run(self, df):
        return self.spark.range(3)


class Broken(Step):
    def run(self, df):
        return None


def test_pipeline_threads_the_frame(spark, caplog):
    caplog.set_level(logging.INFO)
    result = Pipeline([Start(), AddOne(), AddOne()]).run()
    assert [row[0] for row in result.collect()] == [2, 3, 4]
    assert sum("AddOne: start" in message for message in caplog.messages) == 2


def test_pipeline_rejects_other_results_and_logs_failure(spark, caplog):
    with pytest.raises(TypeError, match="Broken"):
        Pipeline([Start(), Broken()]).run()
    assert any("failed" in message for message in caplog.messages)


def test_empty_pipeline_returns_its_input(spark):
    df = spark.range(1)
    assert Pipeline([]).run(df) is df


def test_session_precedence():
    local = session.session_conf(env={})
    assert local["spark.master"] == "local[4]" and local["spark.app.name"] == "local"
    cluster = session.session_conf(
        {"spark.sql.session.timeZone": "CET"},
        delta=True,
        env={"KUBERNETES_SERVICE_HOST": "x", "SPARK_APP_NAME": "job"},
    )
    assert "spark.master" not in cluster
    assert cluster["spark.app.name"] == "job"
    assert cluster["spark.sql.session.timeZone"] == "CET"
    assert "io.delta" in cluster["spark.sql.extensions"]


def test_scratch_is_below_the_configured_folder(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.fixture(scope="module")
def stored_quotes(spark):
    return session.stored(views.bars(spark, SMALL), "plan-quotes")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stock_filters_and_columns_reach_the_scan(spark, stored_quotes):
    plan = plan_of(filter_stocks(stored_quotes).select("ticker", "close_price"))
    assert "EqualTo(market_type,010)" in plan and "EqualTo(bdi_code,02)" in plan
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "open_price" not in schema and "close_price" in schema


def test_all_ticker_windows_share_one_shuffle(spark, stored_quotes):
    priced = normalize_price(filter_stocks(stored_quotes))
    framed = ind.slow_stochastic(ind.log_return(priced))
    framed = ind.trend_flags(ind.moving_average(framed))
    measures = [("log_return", 90, "r")]
    plan = plan_of(rolling_medians(framed, measures, key="ticker", order="trade_date"))
    assert plan.count("Exchange hashpartitioning(ticker#") == 1
    assert plan.count("Sort [") == 1 and plan.count("FileScan") == 1


def test_event_joins_are_equi_joins(spark, stored_quotes):
    priced = normalize_price(filter_stocks(stored_quotes))
    listed = ev.listed_events(views.corp_events(spark, SMALL))
    adjusted = ev.back_adjust(priced, ev.all_events(listed, ev.inferred_events(priced)))
    plan = plan_of(adjusted)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scratch_copies_end(spark):
    with session.scratch(spark):
        kept = session.stored(spark.range(3), "copy")
        (file,) = kept.inputFiles()[:1]
        assert os.path.exists(file.removeprefix("file://")) and kept.count() == 3
    assert not os.path.exists(os.path.dirname(file.removeprefix("file://")))


def test_cluster_without_shared_folder_fails():
    for master in ("local-cluster[2,1,1024]", "spark://host:7077"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.scratch_path(fake, "x")


def test_stock_job_end_to_end(spark, tmp_path):
    source, events = str(tmp_path / "raw"), str(tmp_path / "events")
    views.bars(spark, SMALL).drop("year").write.parquet(source)
    views.corp_events(spark, SMALL).write.parquet(events)
    target, features = str(tmp_path / "quotes"), str(tmp_path / "features")
    for _ in range(2):
        run_stock_job(spark, source, target, events, features, min_trades=2)
    quotes, result = tables.scan_table(spark, target), tables.scan_table(spark, features)
    assert quotes.count() == spark.read.parquet(source).count()
    assert result.columns[-1] == "year" and len(result.columns) == 48
    assert result.count() == filter_stocks(quotes).count()
    last = result.groupBy("isin_code").agg(F.max_by("adjustment", "trade_date").alias("a"))
    assert last.where("a <= 0").count() == 0


def test_features_of_bucketed_quotes_need_no_shuffle_on_ticker(spark, stored_quotes, tmp_path):
    path = str(tmp_path / "quotes")
    quotes = tables.sink_bucketed(stored_quotes, "bucketed_quotes", path, "ticker", "trade_date", 4)
    try:
        names = [name for name in os.listdir(path) if name.endswith(".parquet")]
        assert 1 <= len(names) <= 4
        assert quotes.count() == stored_quotes.count()
        events = views.corp_events(spark, SMALL)
        for table, shuffles in ((quotes, 0), (stored_quotes, 1)):
            plan = stock_features(table, events, min_trades=1)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("hashpartitioning(ticker") == shuffles
        # Rows of one ticker stand in one file, by date.
        places = quotes.select(F.input_file_name().alias("file"), "ticker").distinct()
        assert places.count() == places.select("ticker").distinct().count()
    finally:
        spark.sql("DROP TABLE bucketed_quotes")


def _shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(place).getName() for place in range(files.size())}
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_stored_copies_leave_no_shuffle_files(spark):
    rows = spark.range(1000).repartition(7, "id").groupBy(F.col("id") % 3).count()
    before = _shuffled(spark)
    copy = session.stored(rows, "copy")
    assert not _shuffled(spark) - before
    assert sorted(r[0] for r in copy.collect()) == [0, 1, 2]
    # The rows can be asked for again, and the session's setting is as it was.
    assert rows.count() == 3 and spark.conf.get(session._CLEANUP, None) in (None, "false")


def test_quotes_in_order_are_the_same_rows(spark):
    plain, laid = (views.bars(spark, SMALL, in_order=x) for x in (False, True))
    assert plain.schema == laid.schema
    assert plain.exceptAll(laid).isEmpty() and laid.exceptAll(plain).isEmpty()
    # Lines move as they are: no sums of tasks between the two shuffles.
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_suppkey" in plan and "trade_date" not in plan.split("hashpartitioning(l_suppkey")[1].split(")")[0]


def test_bucketed_copy_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffled(spark)
    quotes = spark.range(100).select((F.col("id") % 5).cast("string").alias("ticker"), F.col("id").alias("trade_date"))
    kept = tables.sink_bucketed(quotes, "freed_series", str(tmp_path / "t"), "ticker", "trade_date", 3)
    assert not _shuffled(spark) - before and kept.count() == 100
    spark.sql("DROP TABLE freed_series")
