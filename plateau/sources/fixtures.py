"""Views with the reference's data shapes, derived from the driver tables.

Every view is a lazy DataFrame over the given parquet tables, so its size grows
with them. The equivalent DuckDB text of each view (used by the oracles) sits next
to the Spark builder as ``SQL_<NAME>``; both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plateau.config import INGREDIENT_EVENTS, INTERACTION_WEIGHTS
from plateau.functions.common import epoch_seconds, weight_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k")


# -- interactions (small): events -> reference shape --------------------------------

_SMALL_EVENT_NAMES = [
    ("view", "Recipe Viewed"),
    ("click", "Recipe Link Clicked"),
    ("purchase", "Recipe Cooked"),
    ("signup", "Recipe Search Queried"),
]
_SMALL_OTHER = "Recipe Removed From Collections"


def _small_event_name(c: Column) -> Column:
    expr = F.lit(_SMALL_OTHER)
    for raw, name in reversed(_SMALL_EVENT_NAMES):
        expr = F.when(c == raw, F.lit(name)).otherwise(expr)
    return expr


def interactions_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (user_id, recipe_id, event_type, rating, datetime, timestamp, seq,
    version, device_type, platform)."""
    ev = table(spark, sf_dir, "events")
    event_type = _small_event_name(F.col("event_type"))
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        _k(F.col("props")).alias("recipe_id"),
        event_type.alias("event_type"),
        weight_of(event_type).alias("rating"),
        F.col("ts").alias("datetime"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 2 == 0, "v1").otherwise("v2").alias("version"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % 3 == 0, "tablet").otherwise("phone").alias("device_type"),
        F.when(F.col("user_id") % 3 == 0, "ios").when(F.col("user_id") % 3 == 1, "android")
        .otherwise("unknown").alias("platform"),
    )


SQL_INTERACTIONS_SMALL = """
SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS recipe_id,
       CASE event_type WHEN 'view' THEN 'Recipe Viewed' WHEN 'click' THEN 'Recipe Link Clicked'
            WHEN 'purchase' THEN 'Recipe Cooked' WHEN 'signup' THEN 'Recipe Search Queried'
            ELSE 'Recipe Removed From Collections' END AS event_type,
       CAST(CASE event_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 2.0 WHEN 'purchase' THEN 5.0
            WHEN 'signup' THEN 0.5 ELSE -2.0 END AS DOUBLE) AS rating,
       ts AS datetime, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS "timestamp",
       event_id AS seq,
       CASE WHEN event_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS version,
       CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'tablet' ELSE 'phone' END AS device_type,
       CASE WHEN user_id % 3 = 0 THEN 'ios' WHEN user_id % 3 = 1 THEN 'android' ELSE 'unknown' END AS platform
FROM events
"""


# -- interactions (large): orders x lineitem, user = customer, item = part ------------

def _large_event_name() -> Column:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return (F.when(rf == "R", "Recipe Removed From Collections")
            .when((rf == "A") & (ls == "F"), "Recipe Cooked")
            .when(rf == "A", "Recipe Favourited")
            .when(ls == "F", "Recipe Cook Started")
            .otherwise("Recipe Viewed"))


_JOIN_ROWS = 1_000_000  # line items of a task that joins them with their orders, about


def _dealt(li: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join, dealt by order into tasks whose rows fit in memory however many there are; a join of a few
    such tasks is left to Spark, which may broadcast a side."""
    tasks = -(-li.count() // _JOIN_ROWS)
    if tasks <= 8:
        return li, orders
    n = max(tasks, int(li.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return li.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey")


def interactions_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
    li, orders = _dealt(li, orders)
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    event_type = _large_event_name()
    seq = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return j.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("recipe_id"),
        event_type.alias("event_type"),
        weight_of(event_type).alias("rating"),
        F.col("o_orderdate").alias("datetime"),
        epoch_seconds(F.col("o_orderdate")).alias("timestamp"),
        seq.alias("seq"),
        F.when(seq % 2 == 0, "v1").otherwise("v2").alias("version"),
        F.when(seq % 7 == 0, F.lit(None).cast("string"))
        .when(seq % 3 == 0, "tablet").otherwise("phone").alias("device_type"),
        F.when(F.col("o_custkey") % 3 == 0, "ios").when(F.col("o_custkey") % 3 == 1, "android")
        .otherwise("unknown").alias("platform"),
    )


SQL_INTERACTIONS_LARGE = """
SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS recipe_id,
       CASE WHEN l_returnflag='R' THEN 'Recipe Removed From Collections'
            WHEN l_returnflag='A' AND l_linestatus='F' THEN 'Recipe Cooked'
            WHEN l_returnflag='A' THEN 'Recipe Favourited'
            WHEN l_linestatus='F' THEN 'Recipe Cook Started' ELSE 'Recipe Viewed' END AS event_type,
       CAST(CASE WHEN l_returnflag='R' THEN -2.0
            WHEN l_returnflag='A' AND l_linestatus='F' THEN 5.0
            WHEN l_returnflag='A' THEN 4.0
            WHEN l_linestatus='F' THEN 3.0 ELSE 1.0 END AS DOUBLE) AS rating,
       o_orderdate AS datetime, CAST(floor(epoch_us(o_orderdate) / 1000000) AS BIGINT) AS "timestamp",
       l_orderkey * 10 + l_linenumber AS seq,
       CASE WHEN (l_orderkey * 10 + l_linenumber) % 2 = 0 THEN 'v1' ELSE 'v2' END AS version,
       CASE WHEN (l_orderkey * 10 + l_linenumber) % 7 = 0 THEN NULL
            WHEN (l_orderkey * 10 + l_linenumber) % 3 = 0 THEN 'tablet' ELSE 'phone' END AS device_type,
       CASE WHEN o_custkey % 3 = 0 THEN 'ios' WHEN o_custkey % 3 = 1 THEN 'android' ELSE 'unknown' END AS platform
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
"""


# -- catalog, bridge, ingredient master ------------------------------------------------

def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("recipe_id"),
        F.col("p_name").alias("recipe_name"),
        F.col("p_type").alias("author_id"),
        F.col("p_brand").alias("author_name"),
        F.when(F.col("p_partkey") % 17 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("p_size").cast("double")).alias("total_time"),
        F.when(F.col("p_partkey") % 11 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("p_partkey") % 8 + 1).alias("servings"),
        F.concat(F.lit('["'), F.lower("p_type"), F.lit('","'),
                 F.regexp_replace("p_name", " ", '","'), F.lit('"]')).alias("tags"),
        F.concat_ws(" ", F.col("p_name"), F.lower("p_type"), F.col("p_brand")).alias("description"),
        F.concat(F.lit("http://shop.example/item/"), F.col("p_partkey").cast("string")).alias("recipe_url"),
    )


SQL_CATALOG_RAW = """
SELECT CAST(p_partkey AS VARCHAR) AS recipe_id, p_name AS recipe_name, p_type AS author_id,
       p_brand AS author_name,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS total_time,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_partkey % 8 + 1 END AS servings,
       concat('["', lower(p_type), '","', replace(p_name, ' ', '","'), '"]') AS tags,
       concat(p_name, ' ', lower(p_type), ' ', p_brand) AS description,
       concat('http://shop.example/item/', CAST(p_partkey AS VARCHAR)) AS recipe_url
FROM part
"""


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recipe -> ingredient rows (duplicates kept)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").cast("string").alias("recipe_id"),
                     F.col("l_suppkey").alias("ingredient_id"))


SQL_BRIDGE = "SELECT CAST(l_partkey AS VARCHAR) AS recipe_id, l_suppkey AS ingredient_id FROM lineitem"


def ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


SQL_INGREDIENTS = "SELECT s_suppkey AS id, s_name AS name FROM supplier"


# -- two item versions sharing a natural key ---------------------------------------------

def items_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.filter(F.col("p_partkey") % 3 != 0).select(
        F.concat(F.lit("A-"), F.col("p_partkey").cast("string")).alias("recipe_id"),
        F.concat(F.lit("http://shop.example/item/"), F.col("p_partkey").cast("string")).alias("recipe_url"),
        F.col("p_name").alias("recipe_name"), F.col("p_brand").alias("recipe_author"))


def items_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    # every item is in one of the versions at least, and a part of them in both
    return p.filter((F.col("p_partkey") % 2 == 0) | (F.col("p_partkey") % 3 == 0)).select(
        F.col("p_partkey").cast("string").alias("recipe_id"),
        F.concat(F.lit("http://shop.example/item/"), F.col("p_partkey").cast("string")).alias("recipe_url"),
        F.when(F.col("p_partkey") % 10 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("recipe_name"),
        F.col("p_brand").alias("recipe_author"))


SQL_ITEMS_V1 = """
SELECT concat('A-', CAST(p_partkey AS VARCHAR)) AS recipe_id,
       concat('http://shop.example/item/', CAST(p_partkey AS VARCHAR)) AS recipe_url,
       p_name AS recipe_name, p_brand AS recipe_author FROM part WHERE p_partkey % 3 <> 0
"""
SQL_ITEMS_V2 = """
SELECT CAST(p_partkey AS VARCHAR) AS recipe_id,
       concat('http://shop.example/item/', CAST(p_partkey AS VARCHAR)) AS recipe_url,
       CASE WHEN p_partkey % 10 = 0 THEN upper(p_name) ELSE p_name END AS recipe_name,
       p_brand AS recipe_author FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0
"""


# -- ranking evaluation input with ties --------------------------------------------------

def eval_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    y = (F.when(F.col("event_type") == "purchase", 5).when(F.col("event_type") == "click", 2)
         .when(F.col("event_type") == "view", 1).otherwise(0))
    return ev.select(F.col("user_id").cast("string").alias("user_id"),
                     y.cast("double").alias("y_true"),
                     F.floor("value").cast("double").alias("y_score"),
                     F.col("event_id").alias("row_id"))


SQL_EVAL_INPUT = """
SELECT CAST(user_id AS VARCHAR) AS user_id,
       CAST(CASE event_type WHEN 'purchase' THEN 5 WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0 END AS DOUBLE) AS y_true,
       CAST(floor(value) AS DOUBLE) AS y_score, event_id AS row_id
FROM events
"""

WEIGHTS = INTERACTION_WEIGHTS


# -- raw JSON event lines derived from events ---------------------------------------------
# One line per event row; v1 = even event_id, v2 = odd. The id-based rules only choose
# which shape a line takes (blank, broken, missing keys, falsy values, ...) so that every
# case of the event scan is exercised; no row is dropped here.
# Each property: (key, Spark expression, DuckDB expression, quoted). A NULL expression
# leaves the key out of the line.

_RAW_PROP_KEYS = [
    ("time", False), ("distinct_id", True), ("$device_id", True), ("device_id", True),
    ("mp_country_code", True), ("$city", True), ("city", True), ("$region", True), ("region", True),
    ("$screen_height", False), ("screen_height", False), ("$screen_width", False), ("recipe_id", False),
    ("current_route", True), ("platform", True), ("mp_lib", True), ("$os", True),
    ("$app_version_string", True), ("is_development", False),
    ("total_ingredients", False), ("owned_ingredients", False),
    ("recipe_url", True), ("recipe_name", True), ("recipe_author", True),
]

_RAW_PROPS_SQL = {
    # whole, fractional, quoted
    "time": "CASE WHEN event_id % 11 = 3 THEN CAST(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS VARCHAR) || '.5' "
            "WHEN event_id % 11 = 7 THEN '\"' || CAST(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS VARCHAR) || '\"' "
            "ELSE CAST(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS VARCHAR) END",
    "distinct_id": "'u' || CAST(user_id AS VARCHAR)",
    "$device_id": "CASE WHEN event_id % 4 = 1 THEN '' ELSE concat('dev', user_id) END",
    "device_id": "concat('d', user_id)",
    "mp_country_code": "['US','GB','DE'][user_id % 3 + 1]",
    "$city": "CASE WHEN event_id % 3 = 0 THEN '' ELSE concat('City', user_id % 7) END",
    "city": "concat('Town', user_id % 5)",
    "$region": "CASE WHEN event_id % 4 <> 2 THEN concat('R', user_id % 4) END",
    "region": "concat('Reg', user_id % 3)",
    "$screen_height": "CASE WHEN event_id % 6 = 0 THEN '0' WHEN event_id % 6 = 1 THEN '\"abc\"' "
                      "WHEN event_id % 6 = 2 THEN NULL ELSE CAST(CAST(floor(value * 40) AS BIGINT) AS VARCHAR) END",
    "screen_height": "CAST(800 + user_id % 400 AS VARCHAR)",
    "$screen_width": "CAST((user_id * 37) % 1400 AS VARCHAR)",
    "recipe_id": "CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 10 < 5 THEN json_extract_string(props, '$.k') "
                 "ELSE concat('\"', json_extract_string(props, '$.k'), '\"') END",
    "current_route": "CASE WHEN event_id % 3 = 1 THEN concat('/recipes/', json_extract_string(props, '$.k'), '/detail') END",
    "platform": "CASE WHEN event_id % 5 >= 2 THEN CASE WHEN user_id % 2 = 0 THEN 'web' ELSE 'android' END END",
    "mp_lib": "CASE WHEN event_id % 5 = 0 THEN 'react-native' END",
    "$os": "['iOS','Android','Windows'][user_id % 3 + 1]",
    "$app_version_string": "CASE WHEN event_id % 7 <> 0 THEN concat('3.', user_id % 4) END",
    "is_development": "CASE WHEN event_id % 9 = 0 THEN 'true' WHEN event_id % 9 = 1 THEN 'false' END",
    "total_ingredients": "CASE WHEN event_id % 4 <> 0 THEN CAST(4 + user_id % 9 AS VARCHAR) END",
    "owned_ingredients": "CASE WHEN event_id % 6 = 0 THEN '\"' || CAST(user_id % 4 AS VARCHAR) || '\"' "
                         "WHEN event_id % 6 < 4 THEN CAST(user_id % 4 AS VARCHAR) END",
    "recipe_url": "CASE WHEN event_id % 8 <> 1 THEN 'http://shop.example/item/' || json_extract_string(props, '$.k') END",
    "recipe_name": "'Item ' || json_extract_string(props, '$.k') || CASE WHEN event_id % 5 = 0 THEN ' (old)' ELSE '' END",
    "recipe_author": "'Author ' || CAST(user_id % 4 AS VARCHAR)",
}


def _raw_props_spark() -> dict:
    i, u, k = F.col("event_id"), F.col("user_id"), F.col("_k")
    s = lambda x: x.cast("string")
    sec = epoch_seconds(F.col("ts"))
    return {
        "time": F.when(i % 11 == 3, F.concat(s(sec), F.lit(".5"))).when(i % 11 == 7, F.concat(F.lit('"'), s(sec), F.lit('"')))
        .otherwise(s(sec)),
        "distinct_id": F.concat(F.lit("u"), s(u)),
        "$device_id": F.when(i % 4 == 1, "").otherwise(F.concat(F.lit("dev"), s(u))),
        "device_id": F.concat(F.lit("d"), s(u)),
        "mp_country_code": F.element_at(F.array(F.lit("US"), F.lit("GB"), F.lit("DE")), (u % 3 + 1).cast("int")),
        "$city": F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("City"), s(u % 7))),
        "city": F.concat(F.lit("Town"), s(u % 5)),
        "$region": F.when(i % 4 != 2, F.concat(F.lit("R"), s(u % 4))),
        "region": F.concat(F.lit("Reg"), s(u % 3)),
        "$screen_height": F.when(i % 6 == 0, "0").when(i % 6 == 1, '"abc"').when(i % 6 == 2, F.lit(None))
        .otherwise(s(F.floor(F.col("value") * 40))),
        "screen_height": s(800 + u % 400),
        "$screen_width": s((u * 37) % 1400),
        "recipe_id": F.when(i % 23 == 0, F.lit(None)).when(i % 10 < 5, k)
        .otherwise(F.concat(F.lit('"'), k, F.lit('"'))),
        "current_route": F.when(i % 3 == 1, F.concat(F.lit("/recipes/"), k, F.lit("/detail"))),
        "platform": F.when(i % 5 >= 2, F.when(u % 2 == 0, "web").otherwise("android")),
        "mp_lib": F.when(i % 5 == 0, "react-native"),
        "$os": F.element_at(F.array(F.lit("iOS"), F.lit("Android"), F.lit("Windows")), (u % 3 + 1).cast("int")),
        "$app_version_string": F.when(i % 7 != 0, F.concat(F.lit("3."), s(u % 4))),
        "is_development": F.when(i % 9 == 0, "true").when(i % 9 == 1, "false"),
        "total_ingredients": F.when(i % 4 != 0, s(4 + u % 9)),
        "owned_ingredients": F.when(i % 6 == 0, F.concat(F.lit('"'), s(u % 4), F.lit('"'))).when(i % 6 < 4, s(u % 4)),
        "recipe_url": F.when(i % 8 != 1, F.concat(F.lit("http://shop.example/item/"), k)),
        "recipe_name": F.concat(F.lit("Item "), k, F.when(i % 5 == 0, " (old)").otherwise("")),
        "recipe_author": F.concat(F.lit("Author "), s(u % 4)),
    }


def _raw_event_name():
    et, i = F.col("event_type"), F.col("event_id")
    return (F.when(et == "view", "Recipe Viewed")
            .when((et == "click") & (i % 7 < 2), INGREDIENT_EVENTS[0]).when((et == "click") & (i % 7 == 2), INGREDIENT_EVENTS[-1])
            .when(et == "click", "$ae_session")
            .when(et == "purchase", "Recipe Cooked").when(et == "signup", "$identify")
            .when(i % 4 == 0, "").otherwise("$ae_first_open"))


_SQL_RAW_EVENT_NAME = (f"CASE WHEN event_type = 'view' THEN 'Recipe Viewed' WHEN event_type = 'click' AND event_id % 7 < 2 THEN '{INGREDIENT_EVENTS[0]}' "
                       f"WHEN event_type = 'click' AND event_id % 7 = 2 THEN '{INGREDIENT_EVENTS[-1]}' WHEN event_type = 'click' THEN '$ae_session' "
                       "WHEN event_type = 'purchase' THEN 'Recipe Cooked' WHEN event_type = 'signup' THEN '$identify' "
                       "WHEN event_id % 4 = 0 THEN '' ELSE '$ae_first_open' END")


_RAW_PART = 8  # properties put together at a time


def raw_event_lines(spark: SparkSession, sf_dir: str, version: str) -> DataFrame:
    """JSON text lines (column ``value``) in the raw event format, for one version.

    The properties are put together a few at a time, each time behind a generator, which the optimizer does not merge: one
    projection of them all becomes a method that the JVM does not compile."""
    ev = table(spark, sf_dir, "events")
    ev = ev.filter((F.col("event_id") % 2) == (0 if version == "v1" else 1)).withColumn("_k", _k(F.col("props")))
    frags = []
    exprs = _raw_props_spark()
    for key, quoted in _RAW_PROP_KEYS:
        expr = exprs[key]
        val = F.concat(F.lit('"'), expr, F.lit('"')) if quoted else expr
        frags.append(F.concat(F.lit(f'"{key}": '), val))
    parts = [frags[j:j + _RAW_PART] for j in range(0, len(frags), _RAW_PART)]
    for j, part in enumerate(parts):
        ev = ev.withColumn(f"_p{j}", F.explode(F.array(F.nullif(F.concat_ws(", ", *part), F.lit("")))))
    props = F.concat(F.lit("{"), F.concat_ws(", ", *[f"_p{j}" for j in range(len(parts))]), F.lit("}"))
    i = F.col("event_id")
    top = F.when(i % 5 == 0, F.concat(F.lit('"distinct_id": "top-'), F.col("user_id").cast("string"), F.lit('"')))
    body = F.concat(F.lit("{"), F.concat_ws(", ", F.concat(F.lit('"event": "'), _raw_event_name(), F.lit('"')),
                                            top, F.concat(F.lit('"properties": '), props)), F.lit("}"))
    line = (F.when(i % 53 == 0, F.lit(""))
            .when(i % 59 == 0, F.expr("substring(_body, 1, length(_body) - 1)"))
            .otherwise(F.col("_body")))
    return ev.withColumn("_body", body).select(line.alias("value"))


def sql_raw_event_lines(version: str) -> str:
    # DuckDB's concat() skips NULLs; '||' propagates them like Spark's concat.
    frags = []
    for key, quoted in _RAW_PROP_KEYS:
        sql = _RAW_PROPS_SQL[key]
        val = f"('\"' || ({sql}) || '\"')" if quoted else f"({sql})"
        frags.append(f"('\"{key}\": ' || {val})")
    props = "('{' || concat_ws(', ', " + ", ".join(frags) + ") || '}')"
    top = "CASE WHEN event_id % 5 = 0 THEN '\"distinct_id\": \"top-' || CAST(user_id AS VARCHAR) || '\"' END"
    body = (f"('{{' || concat_ws(', ', '\"event\": \"' || ({_SQL_RAW_EVENT_NAME}) || '\"', {top}, "
            f"'\"properties\": ' || {props}) || '}}')")
    parity = 0 if version == "v1" else 1
    return (f"SELECT CASE WHEN event_id % 53 = 0 THEN '' WHEN event_id % 59 = 0 THEN substring(b, 1, length(b) - 1) "
            f"ELSE b END AS value FROM (SELECT event_id, {body} AS b FROM events WHERE event_id % 2 = {parity})")


# -- recipe events of two item versions (for reconciliation) ------------------------------

_RECON_NAMES = [("view", "Recipe Viewed"), ("click", "Recipe Link Clicked"), ("purchase", "Recipe Cooked"),
                ("signup", "Recipe Favourited")]


def recipe_events_versioned(spark: SparkSession, sf_dir: str, version: str) -> DataFrame:
    """Events of one version (v1 = even event_id) joined to that version's item snapshot by
    URL; a fifth of the events carry an older item name so first-per-URL matters."""
    ev = table(spark, sf_dir, "events").filter((F.col("event_id") % 2) == (0 if version == "v1" else 1))
    name = F.lit("Recipe Unfavourited")
    for raw, n in reversed(_RECON_NAMES):
        name = F.when(F.col("event_type") == raw, F.lit(n)).otherwise(name)
    items = items_v1(spark, sf_dir) if version == "v1" else items_v2(spark, sf_dir)
    e = ev.select(F.lit(version).alias("version"), name.alias("event_type"),
                  F.concat(F.lit("http://shop.example/item/"), _k(F.col("props"))).alias("recipe_url"),
                  epoch_seconds(F.col("ts")).alias("timestamp"), F.col("event_id").alias("seq"))
    j = e.join(items, "recipe_url")
    return j.select("version", "event_type", "recipe_id", "recipe_url",
                    F.concat(F.col("recipe_name"), F.when(F.col("seq") % 5 == 0, F.lit(" (old)")).otherwise(F.lit("")))
                    .alias("recipe_name"),
                    "recipe_author", "timestamp", "seq")


def sql_recipe_events_versioned(version: str) -> str:
    items = SQL_ITEMS_V1 if version == "v1" else SQL_ITEMS_V2
    parity = 0 if version == "v1" else 1
    return f"""
SELECT '{version}' AS version, e.event_type, i.recipe_id, e.recipe_url,
       i.recipe_name || CASE WHEN e.seq % 5 = 0 THEN ' (old)' ELSE '' END AS recipe_name,
       i.recipe_author, e."timestamp", e.seq
FROM (SELECT CASE event_type WHEN 'view' THEN 'Recipe Viewed' WHEN 'click' THEN 'Recipe Link Clicked'
                  WHEN 'purchase' THEN 'Recipe Cooked' WHEN 'signup' THEN 'Recipe Favourited'
                  ELSE 'Recipe Unfavourited' END AS event_type,
             'http://shop.example/item/' || json_extract_string(props, '$.k') AS recipe_url,
             CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS "timestamp", event_id AS seq
      FROM events WHERE event_id % 2 = {parity}) e
JOIN ({items}) i ON i.recipe_url = e.recipe_url
"""
