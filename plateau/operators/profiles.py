"""Per-user profiles (A01, A26) and user-level content features.

Every profile is one ``groupBy(user_id).agg`` — partial aggregation on the map side,
one shuffle by user. A user holding a large share of all rows only sends one partial
row per map task; the distinct-recipe count is planned as a two-level aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.config import DEFAULT_SERVING_AVG_RATING, INTERACTION_WEIGHTS
from plateau.functions.calendar import whole_days_between
from plateau.functions.common import weight_of
from plateau.operators.stats import modal_values

PROFILE_COLUMNS = [
    "user_id", "total_interactions", "avg_rating", "total_rating", "rating_std",
    "unique_recipes", "first_interaction", "last_interaction", "primary_device",
    "primary_platform", "activity_days", "interactions_per_day", "engagement_score",
]


def user_profiles(interactions: DataFrame) -> DataFrame:
    """Training-mode user profile.

    count / mean / sum / sample std of rating (half-even to 3 places, single-row std -> 0),
    distinct recipes, first/last interaction, modal device and platform (smallest value on
    ties, all-NULL -> 'unknown'), ``activity_days = whole days(last - first) + 1`` and the
    per-day rates rounded to 3 places (the engagement rate uses the rounded total).
    """
    agg = interactions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_interactions"),
        F.bround(F.avg("rating"), 3).alias("avg_rating"),
        F.bround(F.sum("rating"), 3).alias("total_rating"),
        F.coalesce(F.bround(F.stddev_samp("rating"), 3), F.lit(0.0)).alias("rating_std"),
        F.countDistinct("recipe_id").alias("unique_recipes"),
        F.min("datetime").alias("first_interaction"),
        F.max("datetime").alias("last_interaction"),
    )
    modes = modal_values(interactions, "user_id", {"device_type": "primary_device", "platform": "primary_platform"})
    agg = (agg.join(modes, "user_id", "left")
           .withColumn("primary_device", F.coalesce("primary_device", F.lit("unknown")))
           .withColumn("primary_platform", F.coalesce("primary_platform", F.lit("unknown"))))
    days = whole_days_between("first_interaction", "last_interaction") + 1
    return (agg.withColumn("activity_days", days)
            .withColumn("interactions_per_day",
                        F.coalesce(F.bround(F.col("total_interactions") / F.col("activity_days"), 3),
                                   F.lit(0.0)))
            .withColumn("engagement_score",
                        F.bround(F.col("total_rating") / F.col("activity_days"), 3))
            .select(*PROFILE_COLUMNS))


SERVING_PROFILE_COLUMNS = [
    "user_id", "total_interactions", "avg_rating", "total_rating", "rating_std",
    "unique_recipes", "activity_days", "interactions_per_day", "engagement_score",
    "is_mobile_user", "is_ios_user",
]


def serving_profiles(requests: DataFrame, users: DataFrame | None = None,
                     weights: dict[str, float] | None = None) -> DataFrame:
    """Serving-mode profile (A26) from request rows (user_id, recipe_id, event_type, timestamp).

    Unknown event weight -> 1.0; ``activity_days = max(whole days, 1)`` (1 when no time is
    known); no rounding; std of a single row -> 0. ``users`` (a user_id DataFrame) adds
    the default profile for users without any request row.
    """
    w = weights or INTERACTION_WEIGHTS
    r = requests.withColumn("rating", weight_of(F.col("event_type"), w, default=1.0)) \
        .withColumn("_dt", F.timestamp_seconds(F.col("timestamp")))
    agg = r.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_interactions"),
        F.avg("rating").alias("avg_rating"),
        F.sum("rating").alias("total_rating"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("rating_std"),
        F.countDistinct("recipe_id").alias("unique_recipes"),
        F.min("_dt").alias("_first"), F.max("_dt").alias("_last"),
    )
    days = F.coalesce(F.greatest(whole_days_between("_first", "_last"), F.lit(1)), F.lit(1)).cast("bigint")
    prof = (agg.withColumn("activity_days", days)
            .withColumn("interactions_per_day", F.col("total_interactions") / F.col("activity_days"))
            .withColumn("engagement_score", F.col("total_rating") / F.col("activity_days"))
            .withColumn("is_mobile_user", F.lit(1).cast("bigint"))
            .withColumn("is_ios_user", F.lit(1).cast("bigint"))
            .drop("_first", "_last"))
    if users is None:
        return prof.select(*SERVING_PROFILE_COLUMNS)
    defaults = {
        "total_interactions": F.lit(0).cast("bigint"),
        "avg_rating": F.lit(DEFAULT_SERVING_AVG_RATING),
        "total_rating": F.lit(0.0),
        "rating_std": F.lit(0.0),
        "unique_recipes": F.lit(0).cast("bigint"),
        "activity_days": F.lit(1).cast("bigint"),
        "interactions_per_day": F.lit(0.0),
        "engagement_score": F.lit(0.0),
        "is_mobile_user": F.lit(1).cast("bigint"),
        "is_ios_user": F.lit(1).cast("bigint"),
    }
    joined = users.select("user_id").distinct().join(prof, "user_id", "left")
    return joined.select("user_id", *[F.coalesce(F.col(c), d).alias(c) for c, d in defaults.items()])
