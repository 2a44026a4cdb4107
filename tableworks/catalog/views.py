"""The driver tables dressed as the inputs the operators expect, in Spark and in SQL.

Each view covers its whole table. Money is summed in integer cents, so that both engines
see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def cents_sql(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


# --- quotes -----------------------------------------------------------------------------

BARS_SQL = f"""
trades AS (
  SELECT 'I' || l_suppkey AS isin_code,
         'I' || l_suppkey || CASE WHEN CAST(l_shipdate AS DATE) < DATE '1998-07-01'
                                  THEN 'A' ELSE 'B' END AS ticker,
         'Empresa Nº ' || l_suppkey AS company_name,
         CAST(l_shipdate AS DATE) AS trade_date,
         CASE WHEN p_type = 'PROMO' AND l_quantity > 25 THEN 'DRN PROMO'
              WHEN p_type = 'ECONOMY' AND l_quantity > 25 THEN NULL
              ELSE p_type END AS specification,
         CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 1000 END AS quote_factor,
         {cents_sql('l_extendedprice')} AS volume_cents,
         CAST(l_quantity AS BIGINT) AS shares,
         {cents_sql('l_extendedprice')} // CAST(l_quantity AS BIGINT) AS price_cents,
         l_quantity, l_tax
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
bars AS (
  SELECT isin_code, ticker, company_name, trade_date,
         CAST(year(trade_date) AS INTEGER) AS year,
         CASE WHEN min(l_quantity) >= 3 THEN '010' ELSE '070' END AS market_type,
         CASE WHEN max(l_tax) < 0.08 THEN '02' ELSE '96' END AS bdi_code,
         min(specification) AS specification,
         (min(price_cents) + (max(price_cents) - min(price_cents))
           * (CAST(sum(shares) AS BIGINT) % 11) // 10) / 100.0 AS open_price,
         max(price_cents) / 100.0 AS high_price,
         min(price_cents) / 100.0 AS low_price,
         (min(price_cents) + (max(price_cents) - min(price_cents))
           * (CAST(sum(volume_cents) AS BIGINT) % 11) // 10) / 100.0 AS close_price,
         count(*) AS total_trades,
         CAST(sum(shares) AS BIGINT) AS total_quantity,
         CAST(sum(volume_cents) AS BIGINT) / 100.0 AS total_volume,
         CAST(max(quote_factor) AS BIGINT) AS quote_factor
  FROM trades GROUP BY isin_code, ticker, company_name, trade_date
)"""


# In ascending order, so that the smallest code stands for the smallest text.
SPECIFICATIONS = ["DRN PROMO", "ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def bars(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    """Daily quotes: one row per supplier (as ISIN), era (as ticker) and ship date.

    Texts are built after the aggregation: with numbers only, it stays a hash aggregation. Lines
    are made small before they are shuffled, and dealt out by supplier and year as they are: a
    supplier has hardly more lines than days, so sums in the tasks before would only widen the
    rows. ``in_order`` sorts a supplier's days of a year, which makes a stored copy small.
    """
    lots = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("trade_date"),
        cents("l_extendedprice").alias("volume_cents"),
        F.col("l_quantity").cast("long").alias("shares"),
        (F.col("l_quantity") > 25).alias("big"),
        (F.col("l_tax") < 0.08).alias("low_tax"),
    )
    names = F.array(*[F.lit(name) for name in SPECIFICATIONS])
    kind = F.col("p_type")
    big_kind = F.when(kind == "PROMO", F.lit("DRN PROMO")).when(kind == "ECONOMY", F.lit(None)).otherwise(kind)
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.array_position(names, kind).alias("small_code"),
        F.array_position(names, big_kind).alias("big_code"),
    )
    days = (
        lots.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "l_suppkey",
            F.year("trade_date").alias("year"),
            "trade_date",
            F.when(F.col("big"), F.col("big_code")).otherwise(F.col("small_code")).alias("code"),
            "volume_cents",
            "shares",
            "low_tax",
        )
        .repartition("l_suppkey", "year")
        .withColumn("price_cents", F.expr("volume_cents div shares"))
        .groupBy("l_suppkey", "year", "trade_date")
        .agg(
            F.min("shares").alias("smallest"),
            F.bool_and("low_tax").alias("low_tax"),
            F.min("code").alias("specification_code"),
            F.min("price_cents").alias("low"),
            F.max("price_cents").alias("high"),
            F.count("*").alias("total_trades"),
            F.sum("shares").alias("total_quantity"),
            F.sum("volume_cents").alias("volume"),
        )
    )
    if in_order:
        days = days.sortWithinPartitions("l_suppkey", "trade_date")
    supplier = F.col("l_suppkey").cast("string")
    early = F.col("trade_date") < F.lit("1998-07-01").cast("date")
    return days.select(
        F.concat(F.lit("I"), supplier).alias("isin_code"),
        F.concat(F.lit("I"), supplier, F.when(early, "A").otherwise("B")).alias("ticker"),
        F.concat(F.lit("Empresa Nº "), supplier).alias("company_name"),
        "trade_date",
        "year",
        F.when(F.col("smallest") >= 3, "010").otherwise("070").alias("market_type"),
        F.when(F.col("low_tax"), "02").otherwise("96").alias("bdi_code"),
        F.get(names, F.col("specification_code") - 1).alias("specification"),
        (F.expr("low + (high - low) * (total_quantity % 11) div 10") / 100.0).alias("open_price"),
        (F.col("high") / 100.0).alias("high_price"),
        (F.col("low") / 100.0).alias("low_price"),
        (F.expr("low + (high - low) * (volume % 11) div 10") / 100.0).alias("close_price"),
        "total_trades",
        "total_quantity",
        (F.col("volume") / 100.0).alias("total_volume"),
        F.when(F.col("l_suppkey") % 2 == 0, 1).otherwise(1000).cast("long").alias("quote_factor"),
    )


CORP_EVENTS_SQL = """
corp_events AS (
  SELECT 'I' || supplier AS isin_code,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'DESDOBRAMENTO'
                              WHEN '2-HIGH' THEN 'BONIFICACAO'
                              WHEN '3-MEDIUM' THEN 'GRUPAMENTO'
                              WHEN '5-LOW' THEN 'CISAO'
                              ELSE 'RESGATE' END AS label,
         CAST(CASE WHEN o_orderpriority = '3-MEDIUM'
              THEN CASE o_orderstatus WHEN 'F' THEN 0.97 WHEN 'O' THEN 0.98 ELSE 0.975 END
              ELSE CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 2.0 ELSE 0.5 END
         END AS DOUBLE) AS factor,
         CAST(o_orderdate AS DATE) AS last_date_prior
  FROM orders JOIN (SELECT l_orderkey, min(l_suppkey) AS supplier FROM lineitem GROUP BY 1)
    ON o_orderkey = l_orderkey
)"""


def corp_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published events: one per order, on the ISIN of the order's first supplier."""
    suppliers = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("supplier"))
    )
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .join(suppliers, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.concat(F.lit("I"), F.col("supplier").cast("string")).alias("isin_code"),
            F.when(priority == "1-URGENT", "DESDOBRAMENTO")
            .when(priority == "2-HIGH", "BONIFICACAO")
            .when(priority == "3-MEDIUM", "GRUPAMENTO")
            .when(priority == "5-LOW", "CISAO")
            .otherwise("RESGATE")
            .alias("label"),
            F.when(
                priority == "3-MEDIUM",
                F.when(status == "F", 0.97).when(status == "O", 0.98).otherwise(0.975),
            )
            .otherwise(F.when(status == "F", 1.0).when(status == "O", 2.0).otherwise(0.5))
            .alias("factor"),
            F.col("o_orderdate").cast("date").alias("last_date_prior"),
        )
    )


# --- reviews ----------------------------------------------------------------------------

REVIEWS_SQL = """
single_reviews AS (
  SELECT CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS DOUBLE) AS rating,
         CASE WHEN event_type <> 'error' THEN event_type END AS title,
         props AS text,
         [CAST(event_id AS VARCHAR)] AS images,
         'A' || event_type AS asin,
         'P' || event_type AS parent_asin,
         CASE WHEN user_id <> 7 THEN 'U' || user_id END AS user_id,
         (epoch_us(ts) // 3600000000) * 3600000 AS timestamp,
         CASE event_type WHEN 'view' THEN 0 WHEN 'error' THEN NULL
                         ELSE CAST(floor(value) AS BIGINT) END AS helpful_vote,
         event_type = 'purchase' AS verified_purchase
  FROM events
),
reviews AS (
  SELECT * FROM single_reviews
  UNION ALL
  SELECT * FROM single_reviews WHERE asin = 'Aclick'
)"""


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews: hourly timestamps make ids repeat, and every click occurs twice."""
    kind = F.col("event_type")
    user = F.col("user_id")
    whole = F.floor("value")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, F.col("ts"))
    single = (
        table(spark, sf_dir, "events")
        .withColumn("_hours", F.floor(micros / 3_600_000_000))
        .select(
            (whole % 5 + 1).cast("double").alias("rating"),
            F.when(kind != "error", kind).alias("title"),
            F.col("props").alias("text"),
            F.array(F.col("event_id").cast("string")).alias("images"),
            F.concat(F.lit("A"), kind).alias("asin"),
            F.concat(F.lit("P"), kind).alias("parent_asin"),
            F.when(user != 7, F.concat(F.lit("U"), user.cast("string"))).alias("user_id"),
            (F.col("_hours") * 3_600_000).alias("timestamp"),
            F.when(kind == "view", F.lit(0)).when(kind != "error", whole).alias("helpful_vote"),
            (kind == "purchase").alias("verified_purchase"),
        )
    )
    return single.unionByName(single.where(F.col("asin") == "Aclick"))


# --- shop orders ------------------------------------------------------------------------

SHOPPING_SQL = f"""
shopping AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
         o_custkey AS customer_unique_id, l_returnflag AS seller_state,
         c_mktsegment AS customer_state, l_linestatus AS seller_grade,
         p_type AS product_category_name_english, o_orderdate AS order_purchase_timestamp,
         CAST(length(p_name) * 100 + p_size AS BIGINT) AS product_description_lenght,
         CAST(l_quantity AS BIGINT) AS quantity,
         {cents_sql('l_extendedprice')} AS price_cents,
         {cents_sql('l_discount')} AS discount_percent,
         CASE WHEN p_size > 25 THEN {cents_sql('l_tax')} END AS tax_percent,
         {cents_sql('o_totalprice')} AS order_cents,
         {cents_sql('c_acctbal')} AS balance_cents,
         CAST(1 AS BIGINT) AS items
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN part ON l_partkey = p_partkey
                JOIN customer ON o_custkey = c_custkey
)"""

SHOP_LABELS = [
    "order_id",
    "seller_id",
    "customer_unique_id",
    "seller_state",
    "customer_state",
    "seller_grade",
    "product_category_name_english",
    "order_purchase_timestamp",
]
SHOP_MEASURES = [
    "product_description_lenght",
    "quantity",
    "price_cents",
    "discount_percent",
    "tax_percent",
    "order_cents",
    "balance_cents",
    "items",
]


def shopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with product, seller and customer; one measure has gaps, one is constant."""
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    )
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("o_custkey").alias("customer_unique_id"),
        F.col("l_returnflag").alias("seller_state"),
        F.col("c_mktsegment").alias("customer_state"),
        F.col("l_linestatus").alias("seller_grade"),
        F.col("p_type").alias("product_category_name_english"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        (F.length("p_name") * 100 + F.col("p_size"))
        .cast("long")
        .alias("product_description_lenght"),
        F.col("l_quantity").cast("long").alias("quantity"),
        cents("l_extendedprice").alias("price_cents"),
        cents("l_discount").alias("discount_percent"),
        F.when(F.col("p_size") > 25, cents("l_tax")).alias("tax_percent"),
        cents("o_totalprice").alias("order_cents"),
        cents("c_acctbal").alias("balance_cents"),
        F.lit(1).cast("long").alias("items"),
    )


# --- titles -----------------------------------------------------------------------------

TITLES_SQL = r"""
titles AS (
  SELECT 'tt' || p_partkey AS tconst,
         CASE WHEN p_size > 10 THEN 'movie' ELSE 'short' END AS titleType,
         p_name AS primaryTitle,
         upper(p_name) AS originalTitle,
         '0' AS isAdult,
         CAST(1950 + p_size AS VARCHAR) AS startYear,
         '\N' AS endYear,
         CAST(p_size * 3 AS VARCHAR) AS runtimeMinutes,
         CASE p_type WHEN 'PROMO' THEN NULL WHEN 'ECONOMY' THEN '' WHEN 'SMALL' THEN '\N'
                     ELSE replace(p_name, ' ', ',') END AS genres
  FROM part
)"""


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title catalog whose genres are lists, null, empty, or the no-value text."""
    kind = F.col("p_type")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("tt"), F.col("p_partkey").cast("string")).alias("tconst"),
        F.when(F.col("p_size") > 10, "movie").otherwise("short").alias("titleType"),
        F.col("p_name").alias("primaryTitle"),
        F.upper("p_name").alias("originalTitle"),
        F.lit("0").alias("isAdult"),
        (F.col("p_size") + 1950).cast("string").alias("startYear"),
        F.lit(r"\N").alias("endYear"),
        (F.col("p_size") * 3).cast("string").alias("runtimeMinutes"),
        F.when(kind == "PROMO", F.lit(None))
        .when(kind == "ECONOMY", F.lit(""))
        .when(kind == "SMALL", F.lit(r"\N"))
        .otherwise(F.replace("p_name", F.lit(" "), F.lit(",")))
        .alias("genres"),
    )
