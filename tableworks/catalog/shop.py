"""Shop analytics: distinct counts, averages, ranks and rank correlations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import audits, bitmaps, ranks, reshape
from ..session import stored
from . import views
from .registry import query, snap, snap_sql, snapped, snapped_sql

SHOP = f"WITH {views.SHOPPING_SQL}"
COUNTED = [
    "order_id",
    "product_id",
    "seller_id",
    "customer_unique_id",
    "product_category_name_english",
]


@query(f"{SHOP} SELECT count(DISTINCT product_id) AS product_id FROM shopping")
def count_distinct_one(spark, sf_dir):
    shopping = views.shopping(spark, sf_dir)
    return shopping.agg(F.countDistinct("product_id").alias("product_id"))


@query(
    f"""{SHOP} SELECT count(*) AS total,
    {", ".join(f"count(DISTINCT {c}) AS {c}" for c in COUNTED)} FROM shopping"""
)
def count_distinct_many(spark, sf_dir):
    return audits.count_distinct_many(views.shopping(spark, sf_dir), COUNTED)


@query(
    f"""{SHOP} SELECT count(*) AS total,
    {", ".join(f"count(DISTINCT {c}) AS {c}" for c in COUNTED)} FROM shopping"""
)
def count_distinct_merged(spark, sf_dir):
    """The counts over all days from bitmaps that are stored by day."""
    # Stored, so that the tables are joined once and not for every column.
    shopping = views.shopping(spark, sf_dir).select("order_purchase_timestamp", *COUNTED)
    shopping = stored(shopping, "shopping")
    counts = shopping.agg(F.count("*").alias("total"))
    for column in COUNTED:
        # One row each.
        counts = counts.crossJoin(bitmaps.count_bits(daily_bitmaps(shopping, column), name=column))
    return counts


def daily_bitmaps(shopping, column: str):
    dated = shopping.select(F.col("order_purchase_timestamp").cast("date").alias("day"), column)
    values = bitmaps.number_values(dated, column, along="day")
    return stored(bitmaps.bitmaps_by(dated, ["day"], column, values), "bitmaps")


@query(
    f"""{SHOP} SELECT CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
      CAST(month(order_purchase_timestamp) AS INTEGER) AS month,
      count(DISTINCT customer_unique_id) AS customers
    FROM shopping GROUP BY ROLLUP (1, 2)"""
)
def count_distinct_rollup(spark, sf_dir):
    """Customers by month, by year and in all, each merged from the blocks of the level below."""
    days = daily_bitmaps(views.shopping(spark, sf_dir), "customer_unique_id")
    dated = days.withColumns({"year": F.year("day"), "month": F.month("day")})
    months = bitmaps.merged(dated, ["year", "month"])
    years = bitmaps.merged(months, ["year"])
    levels = [
        bitmaps.count_bits(months, ["year", "month"], "customers"),
        bitmaps.count_bits(years, ["year"], "customers"),
        bitmaps.count_bits(years, [], "customers"),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels)


AVERAGES_SQL = ", ".join(f"avg({c}) AS {c}" for c in views.SHOP_MEASURES)
MEASURES = {c: 4 for c in views.SHOP_MEASURES}
FEATURES_SQL = f"""{SHOP}, product_features AS (
  SELECT product_id, count(*) AS purchases, {AVERAGES_SQL} FROM shopping GROUP BY product_id),
feature_values AS (
  UNPIVOT product_features ON COLUMNS(* EXCLUDE (product_id, purchases))
  INTO NAME feature VALUE feature_value)"""


@query(f"{SHOP}, averages AS (SELECT {AVERAGES_SQL} FROM shopping) SELECT {snapped_sql(MEASURES)} FROM averages")
def star_exclude(spark, sf_dir):
    shopping = views.shopping(spark, sf_dir)
    averages = reshape.star_exclude(shopping, ["product_id", *views.SHOP_LABELS])
    return snapped(averages, MEASURES)


@query(f"{FEATURES_SQL} SELECT * REPLACE ({snapped_sql(MEASURES)}) FROM product_features")
def avg_all_features(spark, sf_dir):
    shopping = views.shopping(spark, sf_dir)
    return snapped(reshape.average_all(shopping, "product_id", views.SHOP_LABELS), MEASURES)


@query(
    f"""{SHOP} SELECT {", ".join(views.SHOP_MEASURES)} FROM shopping"""
)
def select_numeric(spark, sf_dir):
    return reshape.select_numeric(
        views.shopping(spark, sf_dir), ["product_id", *views.SHOP_LABELS]
    )


@query(
    f"""{FEATURES_SQL} SELECT product_id, purchases, feature,
    {snap_sql("feature_value", 4)} AS feature_value FROM feature_values"""
)
def unpivot(spark, sf_dir):
    wide = reshape.average_all(views.shopping(spark, sf_dir), "product_id", views.SHOP_LABELS)
    long = reshape.unpivot(wide, ["product_id", "purchases"])
    return snapped(long, {"feature_value": 4})


RANKS_SQL = f"""{SHOP}, product_ranks AS (
  SELECT product_id, product_description_lenght,
         rank() OVER (ORDER BY product_description_lenght) AS description_length_rank,
         rank() OVER (ORDER BY count(*)) AS purchases_rank
  FROM shopping GROUP BY product_id, product_description_lenght)"""


@query(f"{RANKS_SQL} SELECT * FROM product_ranks")
def rank_global(spark, sf_dir):
    groups = (
        views.shopping(spark, sf_dir)
        .groupBy("product_id", "product_description_lenght")
        .agg(F.count("*").alias("purchases"))
    )
    ranked = ranks.rank_by_value(
        groups, "product_description_lenght", "description_length_rank"
    )
    ranked = ranks.rank_by_value(ranked, "purchases", "purchases_rank")
    return ranked.drop("purchases")


@query(
    f"""{FEATURES_SQL} SELECT product_id, feature,
    rank() OVER (PARTITION BY feature ORDER BY feature_value) AS feature_rank,
    rank() OVER (PARTITION BY feature ORDER BY purchases) AS purchases_rank
    FROM feature_values"""
)
def rank_partitioned(spark, sf_dir):
    wide = reshape.average_all(views.shopping(spark, sf_dir), "product_id", views.SHOP_LABELS)
    long = reshape.unpivot(wide, ["product_id", "purchases"])
    ranked = ranks.rank_by_value(long, "feature_value", "feature_rank", within=["feature"])
    ranked = ranks.rank_by_value(ranked, "purchases", "purchases_rank", within=["feature"])
    return ranked.drop("purchases", "feature_value")


def corr_sql(x: str, y: str) -> str:
    return f"CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END"


@query(
    f"""{SHOP} SELECT product_category_name_english,
    {snap_sql(corr_sql("quantity", "price_cents"))} AS correlation FROM shopping GROUP BY 1
    UNION ALL
    SELECT NULL, {snap_sql(corr_sql("quantity", "price_cents"))} FROM shopping"""
)
def corr_group(spark, sf_dir):
    shopping = views.shopping(spark, sf_dir)
    category = "product_category_name_english"
    grouped = audits.corr_group(shopping, "quantity", "price_cents", [category])
    overall = audits.corr_group(shopping, "quantity", "price_cents").select(
        F.lit(None).cast("string").alias(category), "correlation"
    )
    return snapped(grouped.unionByName(overall), {"correlation": 6})


@query(
    f"""{RANKS_SQL} SELECT {snap_sql(corr_sql("description_length_rank", "purchases_rank"))}
    AS spearman_correlation FROM product_ranks"""
)
def spearman_pair(spark, sf_dir):
    correlation = ranks.spearman_pair(
        views.shopping(spark, sf_dir),
        ["product_id", "product_description_lenght"],
        "product_description_lenght",
    )
    return snapped(correlation, {"spearman_correlation": 6})


@query(
    f"""{FEATURES_SQL}, feature_ranks AS (
    SELECT feature, rank() OVER (PARTITION BY feature ORDER BY feature_value) AS feature_rank,
           rank() OVER (PARTITION BY feature ORDER BY purchases) AS purchases_rank
    FROM feature_values)
    SELECT feature, round({corr_sql("feature_rank", "purchases_rank")}, 4)
           AS spearman_correlation FROM feature_ranks GROUP BY feature"""
)
def spearman_all(spark, sf_dir):
    return ranks.spearman_all(
        views.shopping(spark, sf_dir), "product_id", views.SHOP_LABELS
    )
