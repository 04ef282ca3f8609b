"""Profile queries: A01 (train mode) and A26 (serve mode)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plateau.operators import profiles as P
from plateau.plans.canonical import canon_sql
from plateau.plans.registry import query
from plateau.sources import fixtures as X

# DuckDB text of the modal value per user: highest count, smallest value on ties.
_MODE = """
SELECT user_id, {c} AS {alias} FROM (
  SELECT user_id, {c}, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, {c}) AS rn
  FROM i WHERE {c} IS NOT NULL GROUP BY user_id, {c}) WHERE rn = 1
"""

_A01_CORE = """
WITH i AS ({src}),
dev AS ({dev}), plat AS ({plat}),
a AS (
  SELECT user_id, count(*) AS total_interactions,
         round_even(avg(rating), 3) AS avg_rating,
         round_even(sum(rating), 3) AS total_rating,
         coalesce(round_even(stddev_samp(rating), 3), 0.0) AS rating_std,
         count(DISTINCT recipe_id) AS unique_recipes,
         min(datetime) AS first_interaction, max(datetime) AS last_interaction
  FROM i GROUP BY user_id)
SELECT a.*, coalesce(dev.primary_device, 'unknown') AS primary_device,
       coalesce(plat.primary_platform, 'unknown') AS primary_platform,
       floor((epoch_us(last_interaction) - epoch_us(first_interaction)) / 86400000000) + 1 AS activity_days,
       round_even(total_interactions / (floor((epoch_us(last_interaction) - epoch_us(first_interaction)) / 86400000000) + 1), 3) AS interactions_per_day,
       round_even(total_rating / (floor((epoch_us(last_interaction) - epoch_us(first_interaction)) / 86400000000) + 1), 3) AS engagement_score
FROM a LEFT JOIN dev USING (user_id) LEFT JOIN plat USING (user_id)
"""

_A01_TYPES = {"total_interactions": "i", "avg_rating": "d", "total_rating": "d", "rating_std": "d",
              "unique_recipes": "i", "first_interaction": "ts", "last_interaction": "ts",
              "activity_days": "i", "interactions_per_day": "d", "engagement_score": "d"}


def _a01_sql(src: str) -> str:
    return canon_sql(_A01_CORE.format(
        src=src, dev=_MODE.format(c="device_type", alias="primary_device"),
        plat=_MODE.format(c="platform", alias="primary_platform")), _A01_TYPES)


@query("A01_user_profiles", _a01_sql(X.SQL_INTERACTIONS_LARGE))
def a01_user_profiles(spark, sf_dir):
    """Training-mode user profiles over the orders x lineitem interactions."""
    return P.user_profiles(X.interactions_large(spark, sf_dir))


@query("A01_user_profiles_events", _a01_sql(X.SQL_INTERACTIONS_SMALL))
def a01_user_profiles_events(spark, sf_dir):
    """Training-mode user profiles over the event-derived interactions."""
    return P.user_profiles(X.interactions_small(spark, sf_dir))


_A26_SQL = canon_sql("""
WITH r AS (SELECT user_id, recipe_id, event_type, "timestamp" FROM ({src})),
users AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS user_id FROM customer),
p AS (
  SELECT user_id, count(*) AS total_interactions,
         avg(coalesce(w, 1.0)) AS avg_rating, sum(coalesce(w, 1.0)) AS total_rating,
         coalesce(stddev_samp(coalesce(w, 1.0)), 0.0) AS rating_std,
         count(DISTINCT recipe_id) AS unique_recipes,
         greatest(floor((max("timestamp") - min("timestamp")) / 86400), 1) AS activity_days
  FROM (SELECT *, CASE event_type {weights} END AS w FROM r) GROUP BY user_id)
SELECT u.user_id,
       coalesce(total_interactions, 0) AS total_interactions, coalesce(avg_rating, 2.5) AS avg_rating,
       coalesce(total_rating, 0.0) AS total_rating, coalesce(rating_std, 0.0) AS rating_std,
       coalesce(unique_recipes, 0) AS unique_recipes, coalesce(activity_days, 1) AS activity_days,
       coalesce(total_interactions / activity_days, 0.0) AS interactions_per_day,
       coalesce(total_rating / activity_days, 0.0) AS engagement_score,
       1 AS is_mobile_user, 1 AS is_ios_user
FROM users u LEFT JOIN p USING (user_id)
""".format(src=X.SQL_INTERACTIONS_LARGE,
           weights=" ".join(f"WHEN '{k}' THEN {v}" for k, v in X.WEIGHTS.items())),
    {"total_interactions": "i", "avg_rating": "d", "total_rating": "d", "rating_std": "d",
     "unique_recipes": "i", "activity_days": "i", "interactions_per_day": "d",
     "engagement_score": "d", "is_mobile_user": "i", "is_ios_user": "i"})


@query("A26_serving_profiles", _A26_SQL)
def a26_serving_profiles(spark, sf_dir):
    """Serving-mode profiles for every customer, from their request rows (default profile
    for customers without any)."""
    reqs = X.interactions_large(spark, sf_dir).select("user_id", "recipe_id", "event_type", "timestamp")
    users = X.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    return P.serving_profiles(reqs, users)
