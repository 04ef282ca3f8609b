"""DuckDB text of the training-data oracles (kept apart from the Spark side on purpose:
it is an independent statement of the same rules)."""

from __future__ import annotations

from plateau.config import INTERACTION_WEIGHTS
from plateau.functions.hashing import sql_md5_int
from plateau.sources import fixtures as X

AS_OF = "2024-02-15 00:00:00"
SEED = 42


def weight_case(c: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in INTERACTION_WEIGHTS.items()) + " END"


def ctes(src: str) -> str:
    """CTEs: i (interactions), cat, br, pos, neg, pairs, elig, prof, t (pre-impute features)."""
    md5_key = sql_md5_int(f"'{SEED}'", "recipe_id")
    return f"""
i AS ({src}),
br AS ({X.SQL_BRIDGE}),
bs AS (SELECT recipe_id, count(ingredient_id) AS ingredient_count, count(DISTINCT ingredient_id) AS unique_ingredients
       FROM br GROUP BY recipe_id),
cat AS (SELECT c.* REPLACE (TRY_CAST(CAST(c.total_time AS VARCHAR) AS DOUBLE) AS total_time),
               coalesce(bs.ingredient_count, 0) AS ingredient_count,
               coalesce(bs.unique_ingredients, 0) AS unique_ingredients,
               (coalesce(bs.ingredient_count, 0) / 20 + coalesce(TRY_CAST(CAST(c.total_time AS VARCHAR) AS DOUBLE), 40.0) / 60) / 2 AS complexity_score
        FROM ({X.SQL_CATALOG_RAW}) c LEFT JOIN bs USING (recipe_id)),
pos AS MATERIALIZED (
  SELECT user_id, recipe_id, rating, event_type, datetime, version,
         CASE WHEN coalesce({weight_case('event_type')}, 1.0) < 0 THEN 0.1
              ELSE coalesce({weight_case('event_type')}, 1.0) END AS label
  FROM (SELECT user_id, recipe_id, max(rating) AS rating,
               arg_min(event_type, (-coalesce(w, 1.0), seq, event_type)) AS event_type,
               max(datetime) AS datetime, arg_min(version, (seq, version)) AS version
        FROM (SELECT *, {weight_case('event_type')} AS w FROM i) GROUP BY user_id, recipe_id)),
items AS (SELECT DISTINCT recipe_id FROM cat),
ix AS MATERIALIZED (SELECT recipe_id, row_number() OVER (ORDER BY lpad(CAST({md5_key} AS VARCHAR), 10, '0') || '|' || recipe_id) - 1 AS idx
       FROM items),
nn AS (SELECT count(*) AS n FROM ix),
pp AS MATERIALIZED (SELECT min(c.p) AS p FROM (SELECT n + r AS p FROM nn, range(0, 5000) t(r)) c
       WHERE c.p >= 2 AND NOT EXISTS (SELECT 1 FROM range(2, 5000) d(x) WHERE x * x <= c.p AND c.p % x = 0)),
touched AS MATERIALIZED (SELECT DISTINCT user_id, recipe_id FROM pos),
un AS (SELECT user_id, count(*) AS npos FROM touched GROUP BY user_id),
ut AS (SELECT user_id, count(*) AS t FROM touched JOIN ix USING (recipe_id) GROUP BY user_id),
uu AS MATERIALIZED (SELECT un.user_id, least(npos * 4, n - coalesce(t, 0)) AS m, coalesce(t, 0) AS t, n, p,
              1 + {sql_md5_int(f"'{SEED}'", "'a'", "un.user_id")} % (p - 1) AS a,
              {sql_md5_int(f"'{SEED}'", "'b'", "un.user_id")} % p AS b
       FROM un LEFT JOIN ut USING (user_id), nn, pp),
cand AS (SELECT user_id, m, j, (a * j + b) % p AS idx
         FROM (SELECT *, unnest(range(0, m + t + p - n)) AS j FROM uu WHERE m > 0)),
cand2 AS MATERIALIZED (SELECT c.user_id, c.m, c.j, ix.recipe_id FROM cand c JOIN ix USING (idx)
          WHERE NOT EXISTS (SELECT 1 FROM touched x WHERE x.user_id = c.user_id AND x.recipe_id = ix.recipe_id)),
neg AS MATERIALIZED (SELECT user_id, recipe_id, 0.0 AS rating, 0.0 AS label FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY j) AS rn FROM cand2) WHERE rn <= m),
pairs AS MATERIALIZED (SELECT user_id, recipe_id, rating, label, datetime FROM pos
          UNION ALL SELECT user_id, recipe_id, rating, label, NULL AS datetime FROM neg),
elig AS (SELECT * FROM pairs WHERE user_id IN (SELECT user_id FROM pairs WHERE label = 1.0)
                               AND user_id IN (SELECT user_id FROM i)),
dev AS (SELECT user_id, device_type AS primary_device FROM (
  SELECT user_id, device_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, device_type) AS rn
  FROM i WHERE device_type IS NOT NULL GROUP BY user_id, device_type) WHERE rn = 1),
plat AS (SELECT user_id, platform AS primary_platform FROM (
  SELECT user_id, platform, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, platform) AS rn
  FROM i WHERE platform IS NOT NULL GROUP BY user_id, platform) WHERE rn = 1),
pa AS (SELECT user_id, count(*) AS total_interactions, round_even(avg(rating), 3) AS avg_rating,
              round_even(sum(rating), 3) AS total_rating, coalesce(round_even(stddev_samp(rating), 3), 0.0) AS rating_std,
              count(DISTINCT recipe_id) AS unique_recipes, min(datetime) AS first_interaction,
              max(datetime) AS last_interaction FROM i GROUP BY user_id),
prof AS (SELECT pa.*, coalesce(dev.primary_device, 'unknown') AS primary_device,
                coalesce(plat.primary_platform, 'unknown') AS primary_platform,
                floor((epoch_us(last_interaction) - epoch_us(first_interaction)) / 86400000000) + 1 AS activity_days,
                round_even(total_interactions / (floor((epoch_us(last_interaction) - epoch_us(first_interaction)) / 86400000000) + 1), 3) AS interactions_per_day,
                round_even(total_rating / (floor((epoch_us(last_interaction) - epoch_us(first_interaction)) / 86400000000) + 1), 3) AS engagement_score
         FROM pa LEFT JOIN dev USING (user_id) LEFT JOIN plat USING (user_id)),
ac AS (SELECT user_id, author_name, count(*) AS user_author_interaction_count
       FROM (SELECT p.user_id, c.author_name FROM i p LEFT JOIN cat c USING (recipe_id) WHERE p.rating > 0)
       WHERE author_name IS NOT NULL GROUP BY ALL),
re AS (SELECT user_id, recipe_id, count(*) AS user_recipe_interaction_count, max(rating) AS user_recipe_max_rating,
              avg(rating) AS user_recipe_avg_rating, max(datetime) AS user_recipe_last_interaction FROM i GROUP BY ALL),
ui AS (SELECT DISTINCT p.user_id, b.ingredient_id FROM (SELECT DISTINCT user_id, recipe_id FROM i WHERE rating > 0) p
       JOIN br b USING (recipe_id)),
ri AS (SELECT DISTINCT recipe_id, ingredient_id FROM br),
nu AS (SELECT user_id, count(*) AS nu FROM ui GROUP BY user_id),
nr AS (SELECT recipe_id, count(*) AS nr FROM ri GROUP BY recipe_id),
keys AS (SELECT DISTINCT user_id, recipe_id FROM elig),
ov AS (SELECT k.user_id, k.recipe_id, count(*) AS ov FROM keys k JOIN ri USING (recipe_id)
       JOIN ui USING (user_id, ingredient_id) GROUP BY ALL),
sims AS (SELECT k.user_id, k.recipe_id, coalesce(nu, 0) AS nu, coalesce(nr, 0) AS nr, coalesce(ov, 0) AS ov
         FROM keys k LEFT JOIN nu USING (user_id) LEFT JOIN nr USING (recipe_id) LEFT JOIN ov USING (user_id, recipe_id)),
t0 AS (SELECT * FROM elig LEFT JOIN prof USING (user_id) LEFT JOIN cat USING (recipe_id)
       LEFT JOIN (SELECT recipe_id, count(ingredient_id) AS ingredient_count_db FROM br GROUP BY recipe_id) USING (recipe_id)),
t AS (
  SELECT t0.*,
         avg_rating * complexity_score AS user_complexity_match,
         engagement_score / (ingredient_count + 1) AS user_recipe_engagement_match,
         interactions_per_day / (coalesce(total_time, 30.0) + 1) AS user_time_compatibility,
         coalesce(CAST(primary_device = 'phone' AS BIGINT), 0) AS is_mobile_user,
         coalesce(CAST(primary_platform = 'ios' AS BIGINT), 0) AS is_ios_user,
         coalesce(ac.user_author_interaction_count, 0) AS user_author_interaction_count,
         CAST(coalesce(ac.user_author_interaction_count, 0) > 0 AS BIGINT) AS has_interacted_with_author,
         coalesce(ac.user_author_interaction_count, 0) / (total_interactions + 1) AS author_affinity_score,
         coalesce(re.user_recipe_interaction_count, 0) AS user_recipe_interaction_count,
         coalesce(re.user_recipe_max_rating, 0.0) AS user_recipe_max_rating,
         coalesce(re.user_recipe_avg_rating, 0.0) AS user_recipe_avg_rating,
         re.user_recipe_last_interaction,
         CAST(coalesce(re.user_recipe_interaction_count, 0) > 0 AS BIGINT) AS has_interacted_with_recipe,
         coalesce(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(re.user_recipe_last_interaction)) / 86400000000), 999) AS days_since_recipe_interaction,
         1.0 / (1.0 + coalesce(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(re.user_recipe_last_interaction)) / 86400000000), 999) / 30.0) AS recipe_recency_score,
         CASE WHEN s.nu > 0 AND s.nr > 0 THEN s.ov / (s.nu + s.nr - s.ov) ELSE 0.0 END AS ingredient_similarity_score,
         CASE WHEN s.nu > 0 AND s.nr > 0 THEN s.ov ELSE 0 END AS ingredient_overlap_count,
         CASE WHEN s.nu > 0 AND s.nr > 0 AND s.ov > 0 THEN 1 ELSE 0 END AS has_common_ingredients
  FROM t0 LEFT JOIN ac USING (user_id, author_name) LEFT JOIN re USING (user_id, recipe_id)
  LEFT JOIN sims s USING (user_id, recipe_id)),
ti AS (SELECT t.* REPLACE (
          coalesce(CAST(total_time AS DOUBLE), (SELECT coalesce(median(total_time), 0) FROM t)) AS total_time,
          coalesce(CAST(servings AS DOUBLE), (SELECT coalesce(median(servings), 0) FROM t)) AS servings,
          coalesce(CAST(ingredient_count_db AS DOUBLE), (SELECT coalesce(median(ingredient_count_db), 0) FROM t)) AS ingredient_count_db)
       FROM t)
"""


FEATURE_TYPES = {
    "rating": "d", "label": "d", "datetime": "ts", "total_interactions": "i", "avg_rating": "d",
    "total_rating": "d", "rating_std": "d", "unique_recipes": "i", "first_interaction": "ts",
    "last_interaction": "ts", "activity_days": "i", "interactions_per_day": "d", "engagement_score": "d",
    "total_time": "d", "servings": "d", "ingredient_count": "i", "unique_ingredients": "i",
    "complexity_score": "d", "ingredient_count_db": "d", "user_complexity_match": "d",
    "user_recipe_engagement_match": "d", "user_time_compatibility": "d", "is_mobile_user": "i",
    "is_ios_user": "i", "user_author_interaction_count": "i", "has_interacted_with_author": "i",
    "author_affinity_score": "d", "user_recipe_interaction_count": "i", "user_recipe_max_rating": "d",
    "user_recipe_avg_rating": "d", "user_recipe_last_interaction": "ts", "has_interacted_with_recipe": "i",
    "days_since_recipe_interaction": "i", "recipe_recency_score": "d", "ingredient_similarity_score": "d",
    "ingredient_overlap_count": "i", "has_common_ingredients": "i",
}
