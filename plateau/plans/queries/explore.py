"""Exploration report queries over the cleaned combined events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plateau.config import EDA_RECIPE_EVENTS, INGREDIENT_EVENTS
from plateau.operators import explore as E
from plateau.plans.canonical import canon_sql
from plateau.plans.clean_events import combined_events_from_lines
from plateau.plans.queries.events import SQL_COMBINED, cleaned, combined
from plateau.plans.registry import query
from plateau.session import checkpoint_dir
from plateau.sources import fixtures as X
from plateau.streaming import running_totals as RT
from plateau.streaming.events_stream import stream_lines

_REC = ", ".join(f"'{e}'" for e in EDA_RECIPE_EVENTS)

_EV = f"""WITH ev AS (
  SELECT *, make_timestamp(CAST("timestamp" * 1000000 AS BIGINT)) AS datetime,
         CAST(make_timestamp(CAST("timestamp" * 1000000 AS BIGINT)) AS DATE) AS date,
         hour(make_timestamp(CAST("timestamp" * 1000000 AS BIGINT))) AS hour
  FROM ({SQL_COMBINED})),
rec AS (SELECT * FROM ev WHERE event IN ({_REC}))
"""


def _q(body: str, types: dict) -> str:
    return canon_sql(_EV + body, types)


@query("F17_with_calendar", _q("""
SELECT distinct_id, "timestamp", date, hour, month(datetime) AS month, year(datetime) AS year, datetime FROM ev
""", {"timestamp": "d", "date": "date", "hour": "i", "month": "i", "year": "i", "datetime": "ts"}))
def f17_with_calendar(spark, sf_dir):
    ev = E.with_calendar(cleaned(spark, sf_dir))
    return ev.select("distinct_id", "timestamp", "date", "hour", "month", "year", "datetime")


@query("A10_basic_stats", _q("""
SELECT count(*) AS total_events, count(DISTINCT distinct_id) AS unique_users,
       count(DISTINCT device_id) AS unique_devices, min(date) AS first_date, max(date) AS last_date,
       date_diff('day', min(date), max(date)) AS span_days FROM ev
""", {"total_events": "i", "unique_users": "i", "unique_devices": "i", "first_date": "date",
      "last_date": "date", "span_days": "i"}))
def a10_basic_stats(spark, sf_dir):
    return E.basic_stats(cleaned(spark, sf_dir))


@query("A09_events_per_user_stats", _q("""
SELECT avg(n) AS mean, median(n) AS median, min(n) AS min, max(n) AS max, count(*) AS n_users
FROM (SELECT distinct_id, count(*) AS n FROM ev GROUP BY distinct_id)
""", {"mean": "d", "median": "d", "min": "i", "max": "i", "n_users": "i"}))
def a09_events_per_user_stats(spark, sf_dir):
    return E.events_per_user_stats(combined(spark, sf_dir))


@query("A09_recipe_events_per_user_stats", _q("""
SELECT avg(n) AS mean, median(n) AS median, min(n) AS min, max(n) AS max, count(*) AS n_users
FROM (SELECT user_id, count(*) AS n FROM (""" + X.SQL_INTERACTIONS_LARGE + """) GROUP BY user_id)
""", {"mean": "d", "median": "d", "min": "i", "max": "i", "n_users": "i"}))
def a09_recipe_events_per_user_stats(spark, sf_dir):
    """Per-user interaction count distribution over the large interactions view."""
    return E.count_distribution(E.per_user_counts(X.interactions_large(spark, sf_dir), "user_id"))


@query("A11_event_distribution", _q("""
SELECT event, count(*) AS count, count(*) / (SELECT count(*) FROM ev) * 100 AS percentage FROM ev GROUP BY event
""", {"count": "i", "percentage": "d"}))
def a11_event_distribution(spark, sf_dir):
    return E.event_distribution(combined(spark, sf_dir))


@query("A11_recipe_event_distribution", _q("""
SELECT event, count(*) AS count, count(*) / (SELECT count(*) FROM rec) * 100 AS percentage FROM rec GROUP BY event
""", {"count": "i", "percentage": "d"}))
def a11_recipe_event_distribution(spark, sf_dir):
    return E.event_distribution(combined(spark, sf_dir), EDA_RECIPE_EVENTS)


@query("A11_ingredient_event_distribution", _q(f"""
SELECT event, count(*) AS count, count(*) / sum(count(*)) OVER () * 100 AS percentage FROM ev
WHERE event IN ({", ".join(f"'{e}'" for e in INGREDIENT_EVENTS)}) GROUP BY event""", {"count": "i", "percentage": "d"}))
def a11_ingredient_event_distribution(spark, sf_dir):
    """Share of each ingredient event among the ingredient events."""
    return E.ingredient_distribution(combined(spark, sf_dir))


@query("A12_engagement_buckets", _q("""
SELECT count(*) FILTER (WHERE n = 1) AS "users_1", count(*) FILTER (WHERE n BETWEEN 2 AND 5) AS "users_2-5",
       count(*) FILTER (WHERE n BETWEEN 6 AND 10) AS "users_6-10", count(*) FILTER (WHERE n > 10) AS "users_>10"
FROM (SELECT distinct_id, count(*) AS n FROM rec GROUP BY distinct_id)
""", {"users_1": "i", "users_2-5": "i", "users_6-10": "i", "users_>10": "i"}))
def a12_engagement_buckets(spark, sf_dir):
    return E.engagement_buckets(E.recipe_event_rows(combined(spark, sf_dir)))


@query("A13_daily_activity", _q("""
SELECT avg(n) AS mean_per_day, max(n) AS peak_count, arg_min(date, (-n, date)) AS peak_day,
       min(n) AS quietest_count, arg_min(date, (n, date)) AS quietest_day
FROM (SELECT date, count(*) AS n FROM ev GROUP BY date)
""", {"mean_per_day": "d", "peak_count": "i", "peak_day": "date", "quietest_count": "i", "quietest_day": "date"}))
def a13_daily_activity(spark, sf_dir):
    return E.daily_activity(cleaned(spark, sf_dir))


@query("A13_weekday_activity", _q("""
SELECT day_of_week, count(*) AS count, count(*) / (SELECT count(*) FROM ev) * 100 AS percentage
FROM ev GROUP BY day_of_week
""", {"count": "i", "percentage": "d"}))
def a13_weekday_activity(spark, sf_dir):
    return E.weekday_activity(combined(spark, sf_dir))


@query("A13_weekend_split", _q("""
SELECT count(*) FILTER (WHERE is_weekend) AS weekend_events, count(*) FILTER (WHERE NOT is_weekend) AS weekday_events,
       count(*) AS total_events,
       count(*) FILTER (WHERE is_weekend) / count(*) * 100 AS weekend_pct,
       count(*) FILTER (WHERE NOT is_weekend) / count(*) * 100 AS weekday_pct FROM ev
""", {"weekend_events": "i", "weekday_events": "i", "total_events": "i", "weekend_pct": "d", "weekday_pct": "d"}))
def a13_weekend_split(spark, sf_dir):
    return E.weekend_split(cleaned(spark, sf_dir))


@query("W06_hourly_top3", _q("""
SELECT hour, count(*) AS count FROM ev GROUP BY hour ORDER BY count DESC, hour LIMIT 3
""", {"hour": "i", "count": "i"}))
def w06_hourly_top3(spark, sf_dir):
    return E.hourly_top(cleaned(spark, sf_dir), 3)


@query("A14_user_segments", _q("""
SELECT segment, count(*) AS users, avg(n) AS avg_events,
       count(*) / (SELECT count(DISTINCT distinct_id) FROM ev) * 100 AS percentage
FROM (SELECT distinct_id, count(*) AS n,
             CASE WHEN count(*) <= 1 THEN 'One-time User' WHEN count(*) <= 5 THEN 'Light User'
                  WHEN count(*) <= 20 THEN 'Moderate User' WHEN count(*) <= 50 THEN 'Active User'
                  ELSE 'Power User' END AS segment
      FROM ev GROUP BY distinct_id) GROUP BY segment
""", {"users": "i", "avg_events": "d", "percentage": "d"}))
def a14_user_segments(spark, sf_dir):
    return E.user_segments(combined(spark, sf_dir))


def _mode_sql(c: str, alias: str) -> str:
    return f"""(SELECT distinct_id, {c} AS {alias} FROM (
      SELECT distinct_id, {c}, row_number() OVER (PARTITION BY distinct_id ORDER BY count(*) DESC, {c}) AS rn
      FROM ev WHERE {c} IS NOT NULL GROUP BY distinct_id, {c}) WHERE rn = 1)"""


_A08_SQL = f"""
SELECT s.*, coalesce(d.preferred_day, 'Unknown') AS preferred_day, coalesce(t.preferred_time, 'Unknown') AS preferred_time,
       coalesce(v.device_type, 'Unknown') AS device_type, coalesce(p.platform, 'Unknown') AS platform,
       floor((epoch_us(last_seen) - epoch_us(first_seen)) / 86400000000) + 1 AS days_active,
       total_events / (floor((epoch_us(last_seen) - epoch_us(first_seen)) / 86400000000) + 1) AS events_per_day
FROM (SELECT distinct_id, count(event) AS total_events, min(datetime) AS first_seen, max(datetime) AS last_seen
      FROM ev GROUP BY distinct_id) s
LEFT JOIN {_mode_sql('day_of_week', 'preferred_day')} d USING (distinct_id)
LEFT JOIN {_mode_sql('time_of_day', 'preferred_time')} t USING (distinct_id)
LEFT JOIN {_mode_sql('device_type', 'device_type')} v USING (distinct_id)
LEFT JOIN {_mode_sql('platform', 'platform')} p USING (distinct_id)
"""
_A08_TYPES = {"total_events": "i", "first_seen": "ts", "last_seen": "ts", "days_active": "i", "events_per_day": "d"}


@query("A08_user_activity_summary", _q(_A08_SQL, _A08_TYPES))
def a08_user_activity_summary(spark, sf_dir):
    return E.user_activity_summary(combined(spark, sf_dir))


@query("A16_funnel", _q("""
SELECT s.step, s.event, coalesce(u.users, 0) AS users,
       coalesce(u.users, 0) / (SELECT count(DISTINCT distinct_id) FROM rec) * 100 AS percentage
FROM (VALUES (0, 'Recipe Viewed'), (1, 'Recipe Favourited'), (2, 'Recipe Cooked')) s(step, event)
LEFT JOIN (SELECT event, count(DISTINCT distinct_id) AS users FROM rec GROUP BY event) u USING (event)
""", {"step": "i", "users": "i", "percentage": "d"}))
def a16_funnel(spark, sf_dir):
    return E.funnel(E.recipe_event_rows(cleaned(spark, sf_dir)))


@query("A15_insights", _q(f""", summ AS ({_A08_SQL}),
t AS (SELECT count(DISTINCT distinct_id) AS total_users FROM ev),
r AS (SELECT count(DISTINCT distinct_id) AS recipe_users, count(*) AS recipe_interactions,
             count(DISTINCT event) AS recipe_event_types, count(DISTINCT recipe_id) AS recipe_items,
             count(DISTINCT (distinct_id, recipe_id)) FILTER (WHERE distinct_id IS NOT NULL AND recipe_id IS NOT NULL) AS user_item_pairs FROM rec),
a AS (SELECT count(*) AS active_users FROM summ WHERE total_events >= 5),
ar AS (SELECT count(DISTINCT distinct_id) AS active_with_recipes FROM rec
       WHERE distinct_id IN (SELECT distinct_id FROM summ WHERE total_events >= 5))
SELECT *, recipe_users / total_users * 100 AS recipe_engagement_pct, total_users - recipe_users AS cold_start_users,
       (1 - recipe_interactions / (recipe_users * recipe_event_types)) * 100 AS sparsity_pct,
       (1 - user_item_pairs / (recipe_users * recipe_items)) * 100 AS item_sparsity_pct,
       recipe_interactions / recipe_users AS interactions_per_engaged_user,
       total_users - active_with_recipes AS popularity_fallback_users
FROM t, r, a, ar
""", {"total_users": "i", "recipe_users": "i", "recipe_interactions": "i", "recipe_event_types": "i",
      "recipe_items": "i", "user_item_pairs": "i", "active_users": "i", "active_with_recipes": "i",
      "recipe_engagement_pct": "d", "cold_start_users": "i", "sparsity_pct": "d", "item_sparsity_pct": "d",
      "interactions_per_engaged_user": "d", "popularity_fallback_users": "i"}))
def a15_insights(spark, sf_dir):
    ev = combined(spark, sf_dir)
    return E.insights(ev, E.recipe_event_rows(ev), E.user_activity_summary(ev))


_A18_SQL = """
SELECT b.*, greatest(1, floor((last_seen - first_seen) / 86400)) AS days_active, m.event_types
FROM (SELECT distinct_id, count(*) AS total_events,
             count(*) FILTER (WHERE event IN ('Recipe Viewed', 'Recipe Link Clicked', 'Recipe Favourited',
                 'Recipe Cooked', 'Recipe Cook Started', 'Recipe Added To Collections',
                 'Recipe Removed From Collections', 'Recipe Search Queried')) AS recipe_events,
             min("timestamp") AS first_seen, max("timestamp") AS last_seen
      FROM ev GROUP BY distinct_id) b
JOIN (SELECT distinct_id, '{' || string_agg('"' || event || '":' || n, ',' ORDER BY event) || '}' AS event_types
      FROM (SELECT distinct_id, event, count(*) AS n FROM ev GROUP BY ALL) GROUP BY distinct_id) m USING (distinct_id)
"""
_A18_TYPES = {"total_events": "i", "recipe_events": "i", "first_seen": "d", "last_seen": "d", "days_active": "i"}


@query("A18_user_summary", _q(_A18_SQL, _A18_TYPES))
def a18_user_summary(spark, sf_dir):
    return E.user_summary(combined(spark, sf_dir))


@query("A18_running_totals", _q(_A18_SQL, _A18_TYPES))
def a18_running_totals(spark, sf_dir):
    """The same summary from a stateful stream over the raw lines, a few files per micro-batch (S06): totals per
    (user, event) after the last batch."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/totals-{uuid.uuid4().hex}"
    for v in ("v1", "v2"):
        X.raw_event_lines(spark, sf_dir, v).repartition(4).write.text(f"{base}/{v}")
    events = combined_events_from_lines(stream_lines(spark, f"{base}/v1", 2), stream_lines(spark, f"{base}/v2", 2))
    RT.start_running_totals(events, f"{base}/out", f"{base}/_state").awaitTermination()
    return RT.summary_of(RT.latest_totals(spark, f"{base}/out"))


_ONE = """
SELECT 'total' AS report, NULL AS key, n, NULL AS users FROM (SELECT count(*) AS n FROM ev)
UNION ALL SELECT 'event', event, count(*), count(DISTINCT distinct_id) FROM ev GROUP BY event
UNION ALL SELECT 'recipe_event', event, count(*), count(DISTINCT distinct_id) FROM rec GROUP BY event
UNION ALL SELECT 'weekday', day_of_week, count(*), NULL FROM ev GROUP BY day_of_week
UNION ALL SELECT 'weekend', CAST(is_weekend AS VARCHAR), count(*), NULL FROM ev GROUP BY is_weekend
UNION ALL SELECT 'date', CAST(date AS VARCHAR), count(*), NULL FROM ev GROUP BY date
UNION ALL SELECT 'hour', CAST(hour AS VARCHAR), count(*), NULL FROM ev GROUP BY hour
UNION ALL SELECT 'segment', segment, sum(n), count(*) FROM (
  SELECT count(*) AS n, CASE WHEN count(*) <= 1 THEN 'One-time User' WHEN count(*) <= 5 THEN 'Light User'
    WHEN count(*) <= 20 THEN 'Moderate User' WHEN count(*) <= 50 THEN 'Active User' ELSE 'Power User' END AS segment
  FROM ev GROUP BY distinct_id) GROUP BY segment
UNION ALL SELECT 'bucket', bucket, sum(n), count(*) FROM (
  SELECT count(*) AS n, CASE WHEN count(*) = 1 THEN '1' WHEN count(*) <= 5 THEN '2-5' WHEN count(*) <= 10 THEN '6-10' ELSE '>10' END AS bucket
  FROM rec GROUP BY distinct_id) GROUP BY bucket
UNION ALL SELECT 'users', NULL, NULL, count(DISTINCT distinct_id) FROM ev
UNION ALL SELECT 'devices', NULL, NULL, count(DISTINCT device_id) FROM ev
"""


@query("A10_report_in_one_scan", _q(_ONE, {"n": "i", "users": "i"}))
def a10_report_in_one_scan(spark, sf_dir):
    """Totals, event shares, calendar counts, segments and engagement buckets (A10-A14, A16, W06) from one scan."""
    return E.report(E.activity_sets(cleaned(spark, sf_dir)))


@query("A28_interaction_range", canon_sql(f"""
SELECT user_id, count(*) AS n_interactions,
       strftime(make_timestamp(CAST(min("timestamp") * 1000000 AS BIGINT)), '%Y-%m-%d') || ' to ' ||
       strftime(make_timestamp(CAST(max("timestamp") * 1000000 AS BIGINT)), '%Y-%m-%d') AS time_range
FROM ({X.SQL_INTERACTIONS_LARGE}) GROUP BY user_id
""", {"n_interactions": "i"}))
def a28_interaction_range(spark, sf_dir):
    return E.interaction_range(X.interactions_large(spark, sf_dir))


@query("W05_timeline", canon_sql(f"""
SELECT user_id, recipe_id, event_type, "timestamp", seq,
       row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", seq) AS position
FROM ({X.SQL_INTERACTIONS_SMALL})
""", {"timestamp": "i", "seq": "i", "position": "i"}))
def w05_timeline(spark, sf_dir):
    ev = X.interactions_small(spark, sf_dir).select("user_id", "recipe_id", "event_type", "timestamp", "seq")
    return E.timeline(ev)


@query("W11_top_users", _q("""
SELECT distinct_id, count(*) AS events FROM ev GROUP BY distinct_id ORDER BY events DESC, distinct_id LIMIT 10
""", {"events": "i"}))
def w11_top_users(spark, sf_dir):
    return E.top_users(cleaned(spark, sf_dir), 10)
