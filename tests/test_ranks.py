import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tableworks.operators import audits, ranks, reshape
from tableworks.session import stored


def values(spark):
    """Heavy ties, one group with most rows, nulls, infinities and negative numbers."""
    rng = random.Random(5)
    rows = []
    for number in range(3000):
        group = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        value = rng.choice([0.0, 0.0, round(rng.gauss(0, 5), 1), rng.random() * 1e6, None])
        rows.append((number, group, value))
    rows += [(9001, "a", float("-inf")), (9002, "hot", float("inf")), (9003, "b", float("nan"))]
    return spark.createDataFrame(rows, "id long, grp string, value double").cache()


def pairs(df):
    return {row["id"]: row["place"] for row in df.collect()}


@pytest.mark.parametrize("within", [[], ["grp"]])
@pytest.mark.parametrize("tasks", [1, 5, 64])
def test_rank_equals_window_rank(spark, within, tasks):
    df = values(spark)
    window = Window.partitionBy(*within).orderBy(F.asc_nulls_last("value"))
    expected = pairs(df.withColumn("place", F.rank().over(window)))
    got = ranks.rank_by_value(df, "value", "place", within=within, tasks=tasks)
    assert pairs(got) == expected
    assert got.count() == df.count()


@pytest.mark.parametrize(
    "value",
    [
        "CASE WHEN id % 3 = 0 THEN double('inf') ELSE value END",
        "CASE WHEN id % 3 > 0 THEN double('-inf') ELSE double('nan') END",
        "CAST(value AS string)",
        "date_add(DATE '2001-01-01', CAST(id % 50 AS int))",
        "CAST(NULL AS double)",
    ],
)
def test_rank_of_any_type(spark, value):
    df = values(spark).withColumn("value", F.expr(value))
    expected = df.withColumn("place", F.rank().over(Window.orderBy(F.asc_nulls_last("value"))))
    assert pairs(ranks.rank_by_value(df, "value", "place", tasks=16)) == pairs(expected)


def test_ties_are_spread(spark):
    df = values(spark).withColumn("value", F.lit(1.0))
    ranked = ranks.rank_by_value(df, "value", "place", tasks=8)
    assert set(pairs(ranked).values()) == {1}
    placed = df.repartitionByRange(8, "value", F.xxhash64("id", "grp", "value"))
    assert placed.groupBy(F.spark_partition_id()).count().count() == 8


def test_equal_rows_are_spread(spark, monkeypatch):
    """Four rows of five are the same row."""
    df = spark.range(40_000).select(F.when(F.col("id") % 5 < 4, 7.0).otherwise(F.col("id") * 1.0).alias("v"))
    kept = {}
    monkeypatch.setattr(ranks, "stored", lambda table, name: kept.setdefault(name, stored(table, name)))
    ranked = ranks.rank_by_value(df, "v", "place", tasks=8)
    sizes = [r["count"] for r in kept["ranges"].groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8
    want = df.withColumn("place", F.rank().over(Window.orderBy("v")))
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, want.collect()))


def test_parts_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ranks, "PART_ROWS", 500)
    kept = {}
    monkeypatch.setattr(ranks, "stored", lambda table, name: kept.setdefault(name, stored(table, name)))
    ranks.rank_by_value(values(spark), "value", "place")
    assert kept["ranges"].select("_part").distinct().count() == 7


def test_spearman_of_features_with_gaps(spark):
    """Against ranks of each feature's own rows."""
    rng = random.Random(3)
    rows = [(f"p{rng.randrange(40)}", rng.random(), rng.choice([None, 1.0, 2.0]) if rng.random() < 0.2 else None) for _ in range(400)]
    df = spark.createDataFrame(rows, "p string, x double, y double")
    long = reshape.unpivot(reshape.average_all(df, "p", [], "purchases").drop("p"), ["purchases"])
    for name, by in (("a", "feature_value"), ("b", "purchases")):
        long = long.withColumn(name, F.rank().over(Window.partitionBy("feature").orderBy(by)))
    want = {r[0]: r[1] for r in long.groupBy("feature").agg(F.round(F.corr("a", "b"), 4)).collect()}
    found = {r["feature"]: r["spearman_correlation"] for r in ranks.spearman_all(df, "p", []).collect()}
    assert found == want and len(found) == 2


def test_rank_of_one_value(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 4.0)], "id long, value double")
    assert pairs(ranks.rank_by_value(df, "value", "place")) == {1: 1, 2: 1}


def test_rank_plan_has_no_single_task_window_over_rows(spark):
    df = values(spark)
    plan = ranks.rank_by_value(df, "value", "place")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_spearman_of_a_constant_feature_is_null(spark):
    df = spark.createDataFrame(
        [("p1", 1, 5), ("p1", 1, 5), ("p2", 2, 5), ("p3", 3, 5)], "p string, x long, c long"
    )
    found = {
        row["feature"]: row["spearman_correlation"]
        for row in ranks.spearman_all(df, "p", []).collect()
    }
    assert found["c"] is None
    # Ties share the lowest rank: purchases rank 3, 1, 1 against x rank 1, 2, 3.
    assert found["x"] == pytest.approx(-0.866, abs=1e-4)


def test_unpivot_drops_nulls(spark):
    df = spark.createDataFrame([("k", 1.0, None)], "k string, a double, b double")
    assert [tuple(r) for r in reshape.unpivot(df, ["k"]).collect()] == [("k", "a", 1.0)]


def test_glued_keys_may_collide(spark):
    df = spark.createDataFrame([("u1", "23"), ("u12", "3"), (None, "9")], "u string, t string")
    assert audits.duplicate_excess(df, ["u", "t"]).first()[0] == 1


def test_audit_leaves_out_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("u", 2), ("u", 2)], "u string, t long")
    assert audits.dup_audit(df, ["u", "t"]).count() == 2


def test_corr_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert audits.corr_group(df, "x", "y").first()[0] is None
