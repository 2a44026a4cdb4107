import datetime as dt

from pyspark.sql import functions as F

from tableworks.operators import reviews as rev
from tableworks.operators import titles as tit
from tableworks.operators.resample import resample_last
from tableworks.plans.reviews import reviews_clean, run_review_job

SCHEMA = (
    "rating double, title string, text string, images array<struct<url:string>>, asin string, "
    "parent_asin string, user_id string, timestamp long, helpful_vote long, "
    "verified_purchase boolean"
)
# One millisecond before the end of January 2020, UTC.
MONTH_END = 1580515199999


def review(rating=5.0, title="t", text="x", asin="A", user="u", stamp=MONTH_END, votes=0, url="i"):
    return (rating, title, text, [(url,)], asin, "P", user, stamp, votes, True)


def test_projection_edges(spark):
    rows = [review(), review(), review(title=None, votes=None, user=None), review(votes=3, user="v")]
    out = rev.review_projection(spark.createDataFrame(rows, SCHEMA))
    found = {row["id"]: row for row in out.collect()}
    assert set(found) == {f"u_{MONTH_END}", str(MONTH_END), f"v_{MONTH_END}"}
    assert out.columns == [
        "id", "rating", "user_id", "timestamp", "year_month", "full_text", "asin",
        "parent_asin", "helpful_vote", "verified_purchase",
    ]
    plain, bare = found[f"u_{MONTH_END}"], found[str(MONTH_END)]
    assert plain["year_month"] == "2020-01"
    assert plain["full_text"] == '{"title":"t","text":"x"}'
    assert bare["full_text"] == '{"text":"x"}'
    assert plain["helpful_vote"] is False
    assert bare["helpful_vote"] is True
    assert found[f"v_{MONTH_END}"]["helpful_vote"] is True


def test_one_review_per_id(spark):
    rows = [
        review(rating=4.0, text="b"), review(rating=2.0, text="z"), review(rating=2.0, text="c"),
        review(rating=2.0, text="c", url="other"), review(rating=2.0, text="c", asin="B"),
        review(user="w"),
    ]
    clean = reviews_clean(spark.createDataFrame(rows, SCHEMA))
    kept = {row["user_id"]: row for row in clean.collect()}
    assert clean.count() == 2
    assert (kept["u"]["rating"], kept["u"]["asin"]) == (2.0, "A")
    assert '"c"' in kept["u"]["full_text"]


def test_dedup_is_idempotent_and_equals_the_long_way(spark):
    rows = [review(rating=float(n % 4), text=str(n % 9), user=str(n % 13)) for n in range(300)]
    raw = spark.createDataFrame(rows, SCHEMA)
    clean = reviews_clean(raw)
    again = rev.dedup_first(clean, "id", ["rating", "full_text"])
    long_way = rev.dedup_first(rev.review_projection(raw), "id", ["rating", "full_text"])
    assert clean.exceptAll(again).count() == 0
    assert clean.exceptAll(long_way).count() == 0 and long_way.exceptAll(clean).count() == 0


def test_dedup_limits_groups_before_the_shuffle(spark):
    clean = reviews_clean(spark.createDataFrame([review()], SCHEMA))
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def test_review_job_keeps_an_existing_table(spark, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "clean")
    spark.createDataFrame([review()], SCHEMA).write.parquet(source)
    run_review_job(spark, source, target)
    spark.createDataFrame([review(user="new")], SCHEMA).write.mode("append").parquet(source)
    run_review_job(spark, source, target)
    assert [row["user_id"] for row in spark.read.parquet(target).collect()] == ["u"]


def test_titles(spark):
    rows = [
        ("1", "movie", None), ("2", "movie", ""), ("3", "movie", r"\N"), ("4", "movie", "Drama"),
        ("5", "movie", "Drama,Comedy"), ("6", "short", "Drama"),
    ]
    raw = spark.createDataFrame(rows, "tconst string, titleType string, genres string").select(
        "tconst", "titleType", F.lit("o").alias("originalTitle"), F.lit("0").alias("isAdult"),
        F.lit("1999").alias("startYear"), F.lit(r"\N").alias("endYear"),
        F.lit("90").alias("runtimeMinutes"), "genres", F.lit("kept").alias("extra"),
    )
    clean = tit.clean_titles(raw)
    assert clean.columns == ["id", "type", "is_adult", "year", "time_min", "gens", "extra"]
    assert {row["id"]: row["gens"] for row in clean.collect()} == {
        "1": ["non-categorized"], "2": ["non-categorized"], "3": ["non-categorized"],
        "4": ["Drama"], "5": ["Drama", "Comedy"],
    }


def test_resample(spark):
    monday = dt.date(2024, 1, 1)
    rows = [
        ("T", monday, 1.0, 10), ("T", monday + dt.timedelta(days=6), None, 20),
        ("T", monday + dt.timedelta(days=7), None, None), ("T", dt.date(2024, 2, 29), 4.0, None),
    ]
    df = spark.createDataFrame(rows, "ticker string, trade_date date, price double, volume int")
    weekly = {r["period"]: (r["price"], r["volume"]) for r in
              resample_last(df, "ticker", "trade_date").collect()}
    assert weekly == {dt.date(2024, 1, 7): (1.0, 20), dt.date(2024, 3, 3): (4.0, None)}
    monthly = {r["period"]: (r["price"], r["volume"]) for r in
               resample_last(df, "ticker", "trade_date", "ME").collect()}
    assert monthly == {dt.date(2024, 1, 31): (1.0, 20), dt.date(2024, 2, 29): (4.0, None)}
