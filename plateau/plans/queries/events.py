"""Event queries: T05 combined events (S01, S02, P01, P02, P06, F01-F05, F07, U01), F08, F09,
P05 event-name filters, A17 value counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from plateau.config import RECIPE_EVENTS
from plateau.functions.events import format_interaction, item_id_from_route
from plateau.operators import explore as E
from plateau.plans.canonical import canon_sql
from plateau.plans.clean_events import combined_events_from_lines
from plateau.plans.registry import query
from plateau.session import hold
from plateau.sources import fixtures as X


def cleaned(spark, sf_dir):
    """The combined events, for a job that reads them once."""
    return combined_events_from_lines(X.raw_event_lines(spark, sf_dir, "v1"),
                                      X.raw_event_lines(spark, sf_dir, "v2"))


def combined(spark, sf_dir):
    """The combined events, for a job of several branches."""
    return hold(cleaned(spark, sf_dir))


def _jx(path: str) -> str:
    return f"json_extract_string(value, '$.{path}')"


def _prop(key: str) -> str:
    return _jx(f'properties."{key}"')


def _falsy(a: str, b: str) -> str:
    return f"CASE WHEN {a} NOT IN ('', '0') THEN {a} ELSE {b} END"


_INT = "CASE WHEN regexp_full_match({c}, '-?[0-9]+') THEN TRY_CAST({c} AS INTEGER) END"

SQL_COMBINED = f"""
WITH lines AS (
  SELECT 'v1' AS version, value FROM ({X.sql_raw_event_lines('v1')})
  UNION ALL SELECT 'v2' AS version, value FROM ({X.sql_raw_event_lines('v2')})),
ok AS (SELECT * FROM lines WHERE trim(value) <> '' AND json_valid(value) AND json_type(value) = 'OBJECT'),
base AS (
  SELECT {_jx('event')} AS event,
         TRY_CAST({_prop('time')} AS DOUBLE) AS "timestamp",
         {_prop('distinct_id')} AS distinct_id,
         {_falsy(_prop('$device_id'), _prop('device_id'))} AS device_id,
         {_prop('mp_country_code')} AS country_code,
         {_falsy(_prop('$city'), _prop('city'))} AS city,
         {_falsy(_prop('$region'), _prop('region'))} AS region,
         {_falsy(_prop('$screen_height'), _prop('screen_height'))} AS screen_height,
         {_falsy(_prop('$screen_width'), _prop('screen_width'))} AS screen_width,
         CASE WHEN version = 'v1' THEN '' ELSE coalesce({_prop('current_route')}, '') END AS current_route,
         CASE WHEN version = 'v1' THEN 'ios'
              ELSE CASE WHEN coalesce(CASE WHEN {_prop('platform')} <> '' THEN {_prop('platform')} END,
                                      {_prop('mp_lib')}, 'unknown') <> 'react-native'
                        THEN coalesce(CASE WHEN {_prop('platform')} <> '' THEN {_prop('platform')} END,
                                      {_prop('mp_lib')}, 'unknown')
                        WHEN contains(lower(coalesce({_prop('$os')}, '')), 'ios') THEN 'ios'
                        WHEN contains(lower(coalesce({_prop('$os')}, '')), 'android') THEN 'android'
                        ELSE 'mobile' END END AS platform,
         coalesce({_prop('$app_version_string')}, CASE WHEN version = 'v1' THEN '1.0.0' ELSE '2.0.0' END) AS app_version,
         {_prop('recipe_id')} AS recipe_id
  FROM ok
  WHERE version = 'v1' OR NOT coalesce(CAST({_prop('is_development')} AS BOOLEAN), false)),
d AS (SELECT *, make_timestamp(CAST("timestamp" * 1000000 AS BIGINT)) AS t,
             {_INT.format(c='screen_height')} AS h, {_INT.format(c='screen_width')} AS w FROM base)
SELECT CASE WHEN event IS NULL OR event = '' THEN 'Unknown Event'
            WHEN event = '$ae_first_open' THEN 'First Open' WHEN event = '$ae_session' THEN 'Session'
            WHEN event = '$identify' THEN 'User Identified' ELSE event END AS event,
       "timestamp", distinct_id, device_id, country_code, city, region, screen_height, screen_width,
       current_route, platform, app_version, recipe_id,
       CASE WHEN h IS NULL OR w IS NULL THEN 'unknown' WHEN greatest(h, w) >= 1024 THEN 'tablet' ELSE 'mobile' END AS device_type,
       CASE WHEN t IS NULL THEN 'unknown' WHEN hour(t) BETWEEN 5 AND 11 THEN 'morning'
            WHEN hour(t) BETWEEN 12 AND 16 THEN 'afternoon' WHEN hour(t) BETWEEN 17 AND 20 THEN 'evening'
            ELSE 'night' END AS time_of_day,
       coalesce(dayname(t), 'unknown') AS day_of_week,
       isodow(t) >= 6 AS is_weekend
FROM d
"""


@query("T05_combined_events", canon_sql(SQL_COMBINED, {"timestamp": "d"}))
def t05_combined_events(spark, sf_dir):
    """Raw v1/v2 JSON lines -> cleaned combined events (17 fixed columns)."""
    return cleaned(spark, sf_dir)


@query("F08_item_id_from_route", canon_sql(f"""
SELECT current_route,
       CASE WHEN current_route IS NULL OR NOT contains(current_route, '/recipes/')
                 OR coalesce(regexp_extract(current_route, '/recipes/([^/?]*)', 1), '') IN ('', '[id]')
            THEN 'unknown' ELSE regexp_extract(current_route, '/recipes/([^/?]*)', 1) END AS route_recipe_id,
       count(*) AS n
FROM ({SQL_COMBINED}) GROUP BY ALL""", {"n": "i"}))
def f08_item_id_from_route(spark, sf_dir):
    """Recipe id parsed from the app route, counted per route."""
    ev = cleaned(spark, sf_dir)
    return ev.groupBy("current_route", item_id_from_route(F.col("current_route")).alias("route_recipe_id")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("F09_format_interactions", canon_sql(f"""
SELECT distinct_id,
       to_json({{'event_type': event, 'timestamp': CAST(trunc("timestamp") AS BIGINT), 'recipe_id': coalesce(recipe_id, 'unknown')}})::VARCHAR AS interaction
FROM ({SQL_COMBINED})""", {}))
def f09_format_interactions(spark, sf_dir):
    """Interaction JSON per event (recipe id 'unknown' when missing)."""
    ev = cleaned(spark, sf_dir)
    return ev.select("distinct_id", format_interaction(F.col("event"), F.col("timestamp"), F.col("recipe_id"))
                     .alias("interaction"))


_SQL_RECIPE_LIST = ", ".join(f"'{e}'" for e in RECIPE_EVENTS)


@query("P05_filter_recipe_events", canon_sql(f"""
SELECT * FROM ({X.SQL_INTERACTIONS_LARGE}) WHERE event_type IN ({_SQL_RECIPE_LIST}) AND rating > 0
""", {"rating": "d", "datetime": "ts", "timestamp": "i", "seq": "i"}))
def p05_filter_recipe_events(spark, sf_dir):
    """Event-name IN-list filter plus the positive-interaction filter."""
    return E.filter_events(X.interactions_large(spark, sf_dir), RECIPE_EVENTS).filter(F.col("rating") > 0)


@query("A17_value_counts_platform", canon_sql(f"""
SELECT platform AS value, count(*) AS count FROM ({SQL_COMBINED}) GROUP BY platform
""", {"count": "i"}))
def a17_value_counts_platform(spark, sf_dir):
    """Platform distribution of the combined events."""
    return E.value_counts(cleaned(spark, sf_dir), "platform")


@query("A17_value_counts_device", canon_sql(f"""
SELECT device_type AS value, count(*) AS count FROM ({SQL_COMBINED}) GROUP BY device_type
""", {"count": "i"}))
def a17_value_counts_device(spark, sf_dir):
    """Device-type distribution of the combined events."""
    return E.value_counts(cleaned(spark, sf_dir), "device_type")


@query("T05_streaming_combined_events", canon_sql(SQL_COMBINED, {"timestamp": "d"}))
def t05_streaming_combined_events(spark, sf_dir):
    """The same cleaning run as a Structured Streaming job over JSON-lines files: lines
    derived from the events table are written as text files, streamed (available-now
    trigger) through the cleaning plan into Parquet, and read back."""
    import uuid

    from plateau.session import checkpoint_dir
    from plateau.streaming.events_stream import start_clean_events
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    for v in ("v1", "v2"):
        X.raw_event_lines(spark, sf_dir, v).write.mode("overwrite").text(f"{base}/{v}")
    q = start_clean_events(spark, f"{base}/v1", f"{base}/v2", f"{base}/out", f"{base}/_ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("P03_extract_interactions", canon_sql(f"""
WITH lines AS (
  SELECT 'v1' AS version, value FROM ({X.sql_raw_event_lines('v1')})
  UNION ALL SELECT 'v2' AS version, value FROM ({X.sql_raw_event_lines('v2')})),
ok AS (SELECT * FROM lines WHERE trim(value) <> '' AND json_valid(value) AND json_type(value) = 'OBJECT'),
x AS (SELECT version, {_jx('event')} AS event,
             coalesce({_jx('distinct_id')}, {_prop('distinct_id')}) AS user_id,
             coalesce(TRY_CAST({_prop('time')} AS DOUBLE), TRY_CAST({_jx('timestamp')} AS DOUBLE)) AS ts,
             TRY_CAST({_prop('total_ingredients')} AS INTEGER) AS total_i, TRY_CAST({_prop('owned_ingredients')} AS INTEGER) AS owned_i,
             {_prop('recipe_id')} AS recipe_id, {_prop('device_type')} AS device_type, {_prop('$os')} AS os
      FROM ok)
SELECT user_id, recipe_id, event AS event_type,
       CAST(CASE event {" ".join(f"WHEN '{k}' THEN {v}" for k, v in X.WEIGHTS.items())} END AS DOUBLE) AS rating,
       ts AS "timestamp", version, coalesce(device_type, 'unknown') AS device_type, coalesce(os, 'unknown') AS platform,
       total_i AS recipe_total_ingredients, owned_i AS user_owned_ingredients,
       make_timestamp(CAST(ts * 1000000 AS BIGINT)) AS datetime
FROM x WHERE contains(event, 'Recipe') AND event IN ({", ".join(f"'{k}'" for k in X.WEIGHTS)})
  AND recipe_id IS NOT NULL AND recipe_id <> '' AND user_id IS NOT NULL AND user_id <> ''
  AND ts IS NOT NULL AND ts <> 0
""", {"rating": "d", "timestamp": "d", "recipe_total_ingredients": "i", "user_owned_ingredients": "i",
      "datetime": "ts"}))
def p03_extract_interactions(spark, sf_dir):
    """Recipe interactions extracted from the raw v1/v2 JSON lines."""
    from plateau.sources.events import extract_interactions, parse_event_lines
    parts = [extract_interactions(parse_event_lines(X.raw_event_lines(spark, sf_dir, v)), v) for v in ("v1", "v2")]
    return parts[0].unionByName(parts[1])


@query("F19_parse_iso", canon_sql("""
SELECT o_orderkey,
       CASE WHEN o_orderkey % 7 = 0 THEN 'not a date' WHEN o_orderkey % 11 = 0 THEN ''
            WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
            WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS created_at,
       CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL
            WHEN o_orderkey % 3 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) ELSE o_orderdate END AS created_ts
FROM orders""", {"o_orderkey": "i", "created_ts": "ts"}))
def f19_parse_iso(spark, sf_dir):
    """ISO-8601 text (date, 'T' and space forms; junk; empty) -> timestamp or NULL."""
    from plateau.functions.calendar import parse_iso
    o = X.table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = (F.when(k % 7 == 0, "not a date").when(k % 11 == 0, "")
            .when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(k % 3 == 1, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.date_format(d, "yyyy-MM-dd HH:mm:ss")))
    return o.select("o_orderkey", text.alias("created_at")).withColumn("created_ts", parse_iso(F.col("created_at")))


@query("S08_table_roundtrip", canon_sql(SQL_COMBINED, {"timestamp": "d"}))
def s08_table_roundtrip(spark, sf_dir):
    """Combined events written as Parquet partitioned by platform and read back."""
    import uuid

    from plateau.session import checkpoint_dir
    from plateau.sources.events import COMBINED_COLUMNS
    from plateau.sources.io import write_table
    path = f"{checkpoint_dir(spark).rstrip('/')}/combined-{uuid.uuid4().hex}"
    write_table(cleaned(spark, sf_dir), path, partition_by=["platform"])
    return spark.read.parquet(path).select(*COMBINED_COLUMNS)


@query("S05_csv_roundtrip", canon_sql(f"SELECT * FROM ({X.SQL_INTERACTIONS_LARGE})",
                                      {"rating": "d", "datetime": "ts", "timestamp": "i", "seq": "i"}))
def s05_csv_roundtrip(spark, sf_dir):
    """Interactions written as CSV with a header and read back with an explicit schema."""
    import uuid

    from plateau.session import checkpoint_dir
    from plateau.sources.io import read_csv, write_table
    df = X.interactions_large(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/interactions-{uuid.uuid4().hex}"
    write_table(df, path, fmt="csv")
    return read_csv(spark, path, df.schema)


def _scratch(spark, name: str) -> str:
    import uuid

    from plateau.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("S03_read_table", canon_sql("SELECT s_suppkey AS id, s_name AS name FROM supplier", {"id": "i"}))
def s03_read_table(spark, sf_dir):
    """Master-table scan."""
    from plateau.sources.io import read_table
    return read_table(spark, f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


@query("S04_collections", canon_sql("""
SELECT c_custkey AS collection_id, count(DISTINCT l_partkey) AS items
FROM customer LEFT JOIN (orders JOIN lineitem ON l_orderkey = o_orderkey) ON o_custkey = c_custkey GROUP BY c_custkey""",
                                    {"collection_id": "i", "items": "i"}))
def s04_collections(spark, sf_dir):
    """Collections (a customer's purchases) and their bridge, written, read together and counted."""
    from plateau.sources.io import read_collections, write_table
    base = _scratch(spark, "collections")
    o = X.table(spark, sf_dir, "orders").join(X.table(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    write_table(X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("collection_id")), f"{base}/collections")
    write_table(o.select(F.col("o_custkey").alias("collection_id"), F.col("l_partkey").alias("recipe_id")).distinct(),
                f"{base}/collection_of_recipes")
    c, b = read_collections(spark, base)
    return c.join(b, "collection_id", "left").groupBy("collection_id").agg(F.countDistinct("recipe_id").alias("items"))


@query("S10_load_catalog", canon_sql("""
SELECT 'raw' AS source, CAST(p_partkey AS VARCHAR) AS recipe_id, p_name AS recipe_name FROM part
UNION ALL SELECT 'encoded', CAST(p_partkey AS VARCHAR), upper(p_name) FROM part""", {}))
def s10_load_catalog(spark, sf_dir):
    """The raw catalog while there is no encoded one, the encoded one once it is written."""
    from plateau.sources.io import load_catalog, write_table
    base, need = _scratch(spark, "catalog"), ["recipe_id", "recipe_name"]
    part = X.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("recipe_id"), F.col("p_name").alias("recipe_name"))
    write_table(part, f"{base}/raw")
    raw = load_catalog(spark, f"{base}/encoded", f"{base}/raw", need)
    write_table(part.withColumn("recipe_name", F.upper("recipe_name")), f"{base}/encoded")
    encoded = load_catalog(spark, f"{base}/encoded", f"{base}/raw", need)
    return raw.select(F.lit("raw").alias("source"), *need).unionByName(encoded.select(F.lit("encoded").alias("source"), *need))
