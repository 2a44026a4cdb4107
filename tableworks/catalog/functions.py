"""Scalar, array and JSON function groups, each exercised over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import array_mad, array_median as median_of, match_ratio, signed_log
from . import views
from .registry import query, snap, snap_sql, snapped, snapped_sql

MATH = {"ratio": 6, "ln_price": 6, "ln1p_tax": 6, "odd_log": 6}


@query(
    f"""WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      l_extendedprice / nullif(l_tax, 0) AS ratio, ln(l_extendedprice) AS ln_price,
      ln(1 + l_tax) AS ln1p_tax,
      sign(l_quantity - 25) * ln(1 + abs(l_quantity - 25)) AS odd_log,
      CAST(floor(l_quantity / 7) AS BIGINT) AS low, CAST(ceil(l_quantity / 7) AS BIGINT) AS high,
      round(l_quantity / 4) AS quarter FROM lineitem)
    SELECT * REPLACE ({snapped_sql(MATH)}) FROM m"""
)
def fn_math(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity")
    return snapped(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.try_divide("l_extendedprice", "l_tax").alias("ratio"),
            F.ln("l_extendedprice").alias("ln_price"),
            F.log1p("l_tax").alias("ln1p_tax"),
            signed_log(quantity - 25).alias("odd_log"),
            F.floor(quantity / 7).alias("low"),
            F.ceil(quantity / 7).alias("high"),
            F.round(quantity / 4).alias("quarter"),
        ),
        MATH,
    )


@query(
    """SELECT c_custkey, concat_ws('_', c_name, CAST(c_nationkey AS VARCHAR)) AS joined,
      contains(c_mktsegment, 'ING') AS has_ing, string_split(c_name, '#')[2] AS number,
      concat(c_mktsegment, CASE WHEN c_acctbal > 0 THEN c_name END) AS glued,
      trim('  ' || c_mktsegment || ' ') AS trimmed, substring(c_name, 10, 5) AS digits,
      replace(c_name, '#', '-') AS dashed FROM customer"""
)
def fn_string(spark, sf_dir):
    customer = views.table(spark, sf_dir, "customer")
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return customer.select(
        "c_custkey",
        F.concat_ws("_", name, F.col("c_nationkey").cast("string")).alias("joined"),
        F.contains(segment, F.lit("ING")).alias("has_ing"),
        F.get(F.split(name, "#"), F.lit(1)).alias("number"),
        F.concat_ws("", segment, F.when(F.col("c_acctbal") > 0, name)).alias("glued"),
        F.trim(F.concat(F.lit("  "), segment, F.lit(" "))).alias("trimmed"),
        F.substring(name, 10, 5).alias("digits"),
        F.replace(name, F.lit("#"), F.lit("-")).alias("dashed"),
    )


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
      CAST(date_diff('day', DATE '1996-02-29', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
      strftime(o_orderdate, '%Y-%m') AS year_month,
      epoch_us(CAST(o_orderdate AS TIMESTAMP)) // 1000 AS millis,
      CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS compact_date,
      CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS slashed_date
    FROM orders"""
)
def fn_datetime(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    # Midnight of the day in UTC, whatever the session's zone is.
    millis = F.unix_date(day).cast("long") * 86_400_000
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year(day).alias("year"),
        F.datediff(day, F.lit("1996-02-29").cast("date")).alias("days"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.unix_millis(F.timestamp_millis(millis)).alias("millis"),
        F.to_date(F.date_format(day, "yyyyMMdd"), "yyyyMMdd").alias("compact_date"),
        F.to_date(F.date_format(day, "dd/MM/yyyy"), "dd/MM/yyyy").alias("slashed_date"),
    )


@query(
    """SELECT event_id, CASE WHEN value > 10 THEN 'high' WHEN value > 5 THEN 'mid' ELSE 'low' END
      AS level, coalesce(CASE WHEN event_type = 'view' THEN value END, -1.0) AS view_value,
      event_type IN ('click', 'view') AS browsing,
      (CASE WHEN event_type = 'error' THEN 1 END) IS NULL AS fine,
      CAST(value > 5 AS INTEGER) AS flag FROM events"""
)
def fn_conditional(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value")
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(value > 10, "high").when(value > 5, "mid").otherwise("low").alias("level"),
        F.coalesce(F.when(kind == "view", value), F.lit(-1.0)).alias("view_value"),
        kind.isin("click", "view").alias("browsing"),
        F.when(kind == "error", 1).isNull().alias("fine"),
        (value > 5).cast("int").alias("flag"),
    )


@query(
    """WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      [l_linenumber, CAST(l_quantity AS INTEGER), CAST(l_suppkey AS INTEGER)] AS v FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, list_sort(v)[1] AS smallest,
      CAST(len(list_filter(v, lambda x: x > 10)) AS INTEGER) AS above_ten,
      CAST(list_sum(list_transform(v, lambda x: x * 2)) AS BIGINT) AS doubled_sum,
      list_filter(v, lambda x: x > 40)[1] AS first_above_forty FROM a"""
)
def fn_array(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    whole = [F.col(c).cast("int") for c in ("l_linenumber", "l_quantity", "l_suppkey")]
    values = views.table(spark, sf_dir, "lineitem").select(*keys, F.array(*whole).alias("v"))
    doubled = F.transform("v", lambda x: x.cast("long") * 2)
    return values.select(
        *keys,
        F.get(F.array_sort("v"), F.lit(0)).alias("smallest"),
        F.size(F.filter("v", lambda x: x > 10)).alias("above_ten"),
        F.aggregate(doubled, F.lit(0).cast("long"), lambda total, x: total + x).alias(
            "doubled_sum"
        ),
        F.try_element_at(F.filter("v", lambda x: x > 40), F.lit(1)).alias("first_above_forty"),
    )


MEDIANS = {"median": 6, "mad": 6}


@query(
    f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    m AS (SELECT vec_id, e, list_median(e) AS median FROM v),
    d AS (SELECT vec_id, median, list_median(list_transform(e, lambda x: abs(x - median)))
          AS mad FROM m)
    SELECT * REPLACE ({snapped_sql(MEDIANS)}) FROM d"""
)
def array_median(spark, sf_dir):
    values = F.col("embedding").cast("array<double>")
    medians = views.table(spark, sf_dir, "embeddings").select(
        "vec_id", median_of(values).alias("median"), array_mad(values).alias("mad")
    )
    return snapped(medians, MEDIANS)


@query(
    """SELECT event_id, CASE WHEN event_type = 'error'
        THEN '{"text":' || to_json(props) || '}'
        ELSE '{"title":' || to_json(event_type) || ',"text":' || to_json(props) || '}' END
      AS full_text FROM events"""
)
def fn_json(spark, sf_dir):
    kind = F.col("event_type")
    parts = F.struct(F.when(kind != "error", kind).alias("title"), F.col("props").alias("text"))
    return views.table(spark, sf_dir, "events").select(
        "event_id", F.to_json(parts).alias("full_text")
    )


@query(
    f"""WITH c AS (SELECT unnest([1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 10.0, 20.0, 25.0, 50.0,
                                100.0, 1000.0])::DOUBLE AS r),
    either AS (SELECT r AS v FROM c UNION ALL SELECT 1 / r FROM c),
    raw AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                   l_quantity / 7.0 AS ratio FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
      {snap_sql("(SELECT min(v) FROM either WHERE abs(ln(ratio / v)) <= 0.03)")} AS matched
    FROM raw"""
)
def match_round_ratio(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        snap(match_ratio(F.col("l_quantity") / 7.0)).alias("matched"),
    )
