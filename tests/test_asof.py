import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tableworks import session
from tableworks.operators import asof, ranks
from tableworks.operators import events as ev


def sides(spark, kind):
    """One key holds most rows; points tie; keys and points may be null."""
    rng = random.Random(11)

    def point(number):
        if number is None or kind == "int":
            return number
        return date(2001, 1, 1) + timedelta(number) if kind == "date" else f"p{number:04d}"

    def row(number):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        return key, rng.randrange(2), point(rng.choice([None, *range(60)])), number

    left, right = [row(n) for n in range(900)], [row(n) for n in range(300)]
    # Rows that repeat, and a key that one side lacks.
    left += left[:50] + [("only left", 0, point(3), 7)]
    right += right[:20] + [("only right", 0, point(3), 7)]
    typed = {"int": "int", "date": "date", "text": "string"}[kind]
    return left, right, typed


def nearest(left, right, forward, strict):
    found = []
    for key, side, point, number in left:
        best = None
        for other_key, other_side, other_point, value in right:
            if None in (key, point, other_key, other_point) or (key, side) != (other_key, other_side):
                continue
            if other_point == point and strict:
                continue
            if other_point > point if not forward else other_point < point:
                continue
            place = (other_point, value)
            if best is None:
                best = place
            elif other_point == best[0]:
                best = max(best, place)
            elif (other_point < best[0]) == forward:
                best = place
        found.append((key, side, point, number, best and best[1]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("kind", ["int", "date", "text"])
@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_asof_equals_brute_force(spark, kind, forward, strict):
    left, right, typed = sides(spark, kind)
    own = spark.createDataFrame(left, f"k string, s int, p {typed}, n int").repartition(3)
    other = spark.createDataFrame(right, f"k string, s int, q {typed}, v int")
    for tasks in (1, 13):
        got = asof.asof_join(
            own, other, by=["k", "s"], on=("p", "q"), values=["v"],
            forward=forward, strict=strict, tasks=tasks,
        )
        assert got.columns == ["k", "s", "p", "n", "v"]
        assert sorted(map(tuple, got.collect()), key=repr) == nearest(left, right, forward, strict)


def test_asof_of_empty_sides_and_clashes(spark):
    own = spark.createDataFrame([("a", 1), (None, None)], "k string, p int")
    none = spark.createDataFrame([], "k string, q int, v int")
    options = {"by": ["k"], "on": ("p", "q"), "values": ["v"]}
    assert sorted(map(tuple, asof.asof_join(own, none, **options).collect()), key=repr) == [
        ("a", 1, None), (None, None, None),
    ]
    assert asof.asof_join(own.limit(0), none, **options).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        asof.asof_join(own.withColumn("v", F.lit(1)), none, **options)


def test_a_hot_point_is_spread(spark, monkeypatch):
    """All left rows are one row; every part takes its value over the border."""
    kept = {}
    written = asof.stored
    monkeypatch.setattr(asof, "stored", lambda df, name: kept.setdefault(name, written(df, name)))
    own = spark.range(20_000).select(F.lit("a").alias("k"), F.lit(5).alias("p"))
    other = spark.createDataFrame([("a", 3, 1), ("a", 9, 2)], "k string, q int, v int")
    got = asof.asof_join(own, other, by=["k"], on=("p", "q"), values=["v"], tasks=8)
    assert [tuple(r) for r in got.groupBy("v").count().collect()] == [(1, 20_000)]
    sizes = [r["count"] for r in kept["asof"].groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


def test_only_large_keys_are_cut(spark, monkeypatch):
    """Rows of other keys are shuffled once and stored once, rows without a key not shuffled."""
    kept = {}

    def written(df, name):
        kept.setdefault(name, []).append(df)
        return session.stored(df, name)

    for module in (asof, ranks):
        monkeypatch.setattr(module, "stored", written)
    left, right, typed = sides(spark, "date")
    schema = f"k string, s int, p {typed}, n int"
    own = spark.createDataFrame(left, schema).repartition(3)
    other = spark.createDataFrame(right, f"k string, s int, q {typed}, v int")
    options = {"by": ["k", "s"], "on": ("p", "q"), "values": ["v"]}
    want = nearest(left, right, False, False)
    got = asof.asof_join(own, other, **options)
    assert sorted(kept) == ["large-keys", "numbered", "steps"]
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, got.collect()), key=repr) == want

    # Rows that are stored with numbers already are not stored again, and one key is cut.
    kept.clear()
    monkeypatch.setattr(ranks, "PART_ROWS", 150)
    numbered = session.stored(own.withColumn("id", F.monotonically_increasing_id()), "own")
    got = asof.asof_join(numbered, other, number="id", **options)
    assert sorted(kept) == ["asof", "large-keys", "steps"]
    assert got.columns == ["k", "s", "p", "n", "v"]
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert {row["_by_0"] for row in kept["asof"][0].select("_by_0").distinct().collect()} == {"hot"}


def test_points_and_keys_of_two_types(spark):
    """What the left has keeps its type and its value; a key and a point may be all there is."""
    own = spark.createDataFrame([(2**53 + 1, 5), (7, None), (None, 1)], "k long, p int")
    other = spark.createDataFrame([(7, 3.0, "x"), (2**53 + 1, 4.5, "y")], "k long, q double, v string")
    got = asof.asof_join(own, other, by=["k"], on=("p", "q"), values=["v"])
    assert dict(got.dtypes) == {"k": "bigint", "p": "int", "v": "string"}
    assert sorted(map(tuple, got.collect()), key=repr) == [
        (7, None, None), (2**53 + 1, 5, "y"), (None, 1, None),
    ]
    same = asof.asof_join(own, other.withColumn("q", F.col("q").cast("int")), by=["k"], on=("p", "q"), values=["v"])
    assert sorted(map(tuple, same.collect()), key=repr) == [
        (7, None, None), (2**53 + 1, 5, "y"), (None, 1, None),
    ]


def test_adjustment_with_thousands_of_events(spark):
    """Equal to the join by years; no row is multiplied."""
    rng = random.Random(2)
    days = [date(1990, 1, 1) + timedelta(n) for n in range(4000)]
    events = [("I1", day, rng.choice([0.5, 1.0, 2.0])) for day in days for _ in range(2)]
    events += [("I2", days[7], None), ("I2", days[900], 3.0), ("I3", None, 2.0)]
    events = spark.createDataFrame(events, "isin_code string, last_date_prior date, multiplier double")
    quotes = [(isin, day, 4.0, 4.0, 4.0, 4.0, 100) for isin in ("I1", "I2", "I3", "I4") for day in days[::3]]
    quotes = spark.createDataFrame(
        quotes,
        "isin_code string, trade_date date, open_price double, high_price double, low_price double, "
        "close_price double, total_quantity long",
    )
    want = ev.back_adjust(quotes, events).collect()
    got = ev.back_adjust_asof(quotes, events, tasks=9)
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
