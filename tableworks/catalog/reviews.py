"""Review and title queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audits, repeats
from ..operators import reviews as rev
from ..operators import titles as tit
from ..plans.reviews import reviews_clean as clean
from . import views
from .registry import query, snap, snap_sql

# to_json leaves null fields out, so the SQL spells the four shapes.
PROJECTED_SQL = f"""WITH {views.REVIEWS_SQL},
distinct_reviews AS (SELECT DISTINCT * FROM reviews),
projected AS (
  SELECT concat_ws('_', user_id, timestamp) AS id, rating, user_id,
         timestamp AS timestamp_ms,
         strftime(make_timestamp(timestamp * 1000), '%Y-%m') AS year_month,
         CASE WHEN title IS NULL THEN '{{"text":' || to_json(text) || '}}'
              ELSE '{{"title":' || to_json(title) || ',"text":' || to_json(text) || '}}' END
           AS full_text,
         asin, parent_asin,
         CASE WHEN helpful_vote = 0 THEN false ELSE true END AS helpful_vote,
         verified_purchase
  FROM distinct_reviews
)"""


def _with_millis(df):
    """Epoch milliseconds compare the same in any session time zone."""
    return df.withColumn("timestamp", F.unix_millis("timestamp")).withColumnRenamed(
        "timestamp", "timestamp_ms"
    )


FIRST_SQL = f"""{PROJECTED_SQL}
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY rating NULLS FIRST,
            full_text NULLS FIRST, user_id NULLS FIRST, timestamp_ms NULLS FIRST,
            asin NULLS FIRST, parent_asin NULLS FIRST, helpful_vote NULLS FIRST,
            verified_purchase NULLS FIRST) AS place FROM projected)
WHERE place = 1"""


@query(f"{PROJECTED_SQL} SELECT * FROM projected")
def review_projection(spark, sf_dir):
    return _with_millis(rev.review_projection(views.reviews(spark, sf_dir)))


@query(FIRST_SQL)
def dedup_first(spark, sf_dir):
    projected = rev.review_projection(views.reviews(spark, sf_dir))
    return _with_millis(rev.dedup_first(projected, "id", ["rating", "full_text"]))


@query(FIRST_SQL)
def reviews_clean(spark, sf_dir):
    return _with_millis(clean(views.reviews(spark, sf_dir)))


@query(
    f"""WITH {views.REVIEWS_SQL} SELECT DISTINCT rating, title, text, asin, user_id, timestamp,
    helpful_vote, verified_purchase FROM reviews"""
)
def distinct_rows(spark, sf_dir):
    columns = ["rating", "title", "text", "asin", "user_id", "timestamp", "helpful_vote"]
    return views.reviews(spark, sf_dir).select(*columns, "verified_purchase").distinct()


@query(f"WITH {views.REVIEWS_SQL} SELECT count(*) AS rows FROM reviews")
def count_rows(spark, sf_dir):
    return views.reviews(spark, sf_dir).agg(F.count("*").alias("rows"))


@query(
    f"""WITH {views.REVIEWS_SQL} SELECT {snap_sql("avg(rating)")} AS rating FROM reviews"""
)
def mean_column(spark, sf_dir):
    return views.reviews(spark, sf_dir).agg(snap(F.avg("rating")).alias("rating"))


REVIEW_KEYS = ["user_id", "timestamp"]
EXCESS_SQL = f"""WITH {views.REVIEWS_SQL}
    SELECT count(*) - count(DISTINCT concat(user_id, timestamp)) AS duplicate_excess FROM reviews"""
DUPS_SQL = f"""WITH {views.REVIEWS_SQL} SELECT user_id, timestamp, count(*) AS rows
    FROM reviews GROUP BY user_id, timestamp HAVING count(*) > 1"""


@query(EXCESS_SQL)
def duplicate_excess(spark, sf_dir):
    return audits.duplicate_excess(views.reviews(spark, sf_dir), REVIEW_KEYS)


@query(EXCESS_SQL)
def duplicate_excess_filtered(spark, sf_dir):
    """The same from rows that Bloom filters leave."""
    left = repeats.possible_repeats(views.reviews(spark, sf_dir), [audits.joined_key(REVIEW_KEYS)])
    return audits.duplicate_excess(left, REVIEW_KEYS)


@query(DUPS_SQL)
def having_dups(spark, sf_dir):
    return audits.having_dups(views.reviews(spark, sf_dir), REVIEW_KEYS)


@query(DUPS_SQL)
def having_dups_filtered(spark, sf_dir):
    """The same from rows that Bloom filters leave."""
    left = repeats.possible_repeats(views.reviews(spark, sf_dir), REVIEW_KEYS)
    return audits.having_dups(left, REVIEW_KEYS)


AUDIT_COLUMNS = ["rating", "title", "text", "asin", "user_id", "timestamp"]
AUDIT_SQL = f"""WITH {views.REVIEWS_SQL}, base AS (
  SELECT user_id, timestamp FROM reviews GROUP BY user_id, timestamp HAVING count(*) > 1)
SELECT concat(s.user_id, s.timestamp) AS glued_key, {", ".join("s." + c for c in AUDIT_COLUMNS)}
FROM reviews s JOIN base b ON s.user_id = b.user_id AND s.timestamp = b.timestamp
ORDER BY glued_key, rating, s.text, asin, title NULLS FIRST LIMIT 1000"""


def _audit(rows):
    return audits.dup_audit(rows, REVIEW_KEYS, tie_break=["rating", "text", "asin", "title"])


@query(AUDIT_SQL)
def dup_audit_join(spark, sf_dir):
    return _audit(views.reviews(spark, sf_dir).select(*AUDIT_COLUMNS))


@query(AUDIT_SQL)
def dup_audit_filtered(spark, sf_dir):
    """The same from rows that Bloom filters leave."""
    rows = views.reviews(spark, sf_dir).select(*AUDIT_COLUMNS)
    return _audit(repeats.possible_repeats(rows, REVIEW_KEYS))


@query(
    f"""WITH {views.REVIEWS_SQL} SELECT timestamp, text, asin, rating FROM reviews
    ORDER BY timestamp DESC, text, asin, rating LIMIT 1000"""
)
def topk(spark, sf_dir):
    columns = ["timestamp", "text", "asin", "rating"]
    ordered = views.reviews(spark, sf_dir).select(*columns).orderBy(
        F.desc("timestamp"), "text", "asin", "rating"
    )
    return ordered.limit(1000)


# --- titles -----------------------------------------------------------------------------

RENAMED_SQL = f"""WITH {views.TITLES_SQL}, renamed AS (
  SELECT tconst AS id, titleType AS type, primaryTitle, isAdult AS is_adult, startYear AS year,
         runtimeMinutes AS time_min, genres AS gens FROM titles),
movies AS (SELECT * FROM renamed WHERE type = 'movie'),
split AS (
  SELECT * REPLACE (CASE WHEN gens IS NULL OR gens = '' OR gens = '\\N'
                         THEN ['non-categorized'] ELSE string_split(gens, ',') END AS gens)
  FROM renamed)"""


@query(f"{RENAMED_SQL} SELECT * FROM renamed")
def rename_and_drop(spark, sf_dir):
    return tit.rename_and_drop(views.titles(spark, sf_dir))


@query(f"{RENAMED_SQL} SELECT * FROM movies")
def filter_equals(spark, sf_dir):
    return tit.filter_equals(tit.rename_and_drop(views.titles(spark, sf_dir)), "type", "movie")


def _flat_genres(df):
    return df.withColumns({"gens": F.array_join("gens", "|"), "genre_count": F.size("gens")})


@query(
    f"""{RENAMED_SQL} SELECT id, array_to_string(gens, '|') AS gens,
    CAST(len(gens) AS INTEGER) AS genre_count FROM split"""
)
def split_or_default(spark, sf_dir):
    genres = views.titles(spark, sf_dir).select(
        F.col("tconst").alias("id"), tit.split_or_default("genres").alias("gens")
    )
    return _flat_genres(genres)


@query(
    f"""{RENAMED_SQL} SELECT * REPLACE (array_to_string(gens, '|') AS gens),
    CAST(len(gens) AS INTEGER) AS genre_count FROM split WHERE type = 'movie'"""
)
def clean_titles(spark, sf_dir):
    return _flat_genres(tit.clean_titles(views.titles(spark, sf_dir)))
