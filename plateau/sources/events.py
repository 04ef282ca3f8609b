"""Raw event scan and normalisation.

A raw event is one JSON object per line: ``event``, optional top-level
``distinct_id``/``timestamp`` and a nested ``properties`` object. Lines are read as
text and parsed once with an explicit schema (no inference); blank lines and lines that
are not a JSON object are dropped. Every field is read as text: a value of another JSON type
than usual (a quoted or fractional time, a quoted count) is converted where it is used and never
costs the line or the field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateau.config import V1_DEFAULT_APP_VERSION, V1_DEFAULT_PLATFORM, V2_DEFAULT_APP_VERSION
from plateau.functions.calendar import day_of_week, is_weekend, time_of_day
from plateau.functions.events import clean_event_name, device_type, falsy_coalesce, resolve_platform

_S = T.StringType()
PROPERTIES_SCHEMA = T.StructType([
    T.StructField("time", _S), T.StructField("distinct_id", _S),
    T.StructField("$device_id", _S), T.StructField("device_id", _S),
    T.StructField("mp_country_code", _S),
    T.StructField("$city", _S), T.StructField("city", _S),
    T.StructField("$region", _S), T.StructField("region", _S),
    T.StructField("$screen_height", _S), T.StructField("screen_height", _S),
    T.StructField("$screen_width", _S), T.StructField("screen_width", _S),
    T.StructField("recipe_id", _S), T.StructField("recipe_url", _S),
    T.StructField("recipe_name", _S), T.StructField("recipe_author", _S),
    T.StructField("recipe_cooking_time", _S), T.StructField("recipe_servings", _S),
    T.StructField("recipe_tags", _S),
    T.StructField("current_route", _S), T.StructField("platform", _S),
    T.StructField("mp_lib", _S), T.StructField("$os", _S),
    T.StructField("$app_version_string", _S), T.StructField("is_development", _S),
    T.StructField("device_type", _S),
    T.StructField("total_ingredients", _S),
    T.StructField("owned_ingredients", _S),
])
EVENT_SCHEMA = T.StructType([
    T.StructField("event", _S), T.StructField("distinct_id", _S),
    T.StructField("timestamp", _S), T.StructField("properties", PROPERTIES_SCHEMA),
])

COMBINED_COLUMNS = [
    "event", "timestamp", "distinct_id", "device_id", "country_code", "city", "region",
    "screen_height", "screen_width", "current_route", "platform", "app_version", "recipe_id",
    "device_type", "time_of_day", "day_of_week", "is_weekend",
]


def parse_event_lines(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Text lines -> parsed events (columns ``event, distinct_id, timestamp, properties``).

    Blank lines and lines that are not a JSON object are dropped silently (S01). A line is
    made and parsed once; the generators keep the optimizer from repeating either in the filters. Only a
    line that the schema could not hold (properties that are no object) is looked at again.
    """
    v = F.col("_line")
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField("_corrupt", _S)])
    parsed = F.from_json(v, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = (lines.select(F.explode(F.array(text_col)).alias("_line")).filter(v.rlike(r"^\s*\{"))
            .select(v, F.explode(F.array(parsed)).alias("e")))
    ok = F.when(F.col("e._corrupt").isNull(), True).otherwise(F.json_object_keys("_line").isNotNull())
    return rows.filter(ok).select(*[F.col(f"e.`{f.name}`") for f in EVENT_SCHEMA.fields])


def epoch_of(c) -> Column:
    """Epoch seconds as double from a number or numeric text; anything else -> NULL."""
    t = c.cast("string").try_cast("double")
    return F.when(~F.isnan(t) & (F.abs(t) < float("inf")), t)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines event scan (S01); each file split is parsed in parallel."""
    return parse_event_lines(spark.read.text(path))


def normalize_events(parsed: DataFrame, version: str) -> DataFrame:
    """Version-specific projection of the combined-events base columns.

    v2 drops development events (missing flag keeps the event). v1 gets an empty route,
    platform 'ios' and app version default '1.0.0'; v2 reads route and platform from the
    properties, app version default '2.0.0'.
    """
    p = lambda name: F.col("properties").getField(name)
    df = parsed
    if version == "v2":
        df = df.filter(~F.coalesce(p("is_development").try_cast("boolean"), F.lit(False)))
    if version == "v1":
        route, platform = F.lit(""), F.lit(V1_DEFAULT_PLATFORM)
        app = F.coalesce(p("$app_version_string"), F.lit(V1_DEFAULT_APP_VERSION))
    else:
        route = F.coalesce(p("current_route"), F.lit(""))
        platform = resolve_platform(p("platform"), p("mp_lib"), p("$os"))
        app = F.coalesce(p("$app_version_string"), F.lit(V2_DEFAULT_APP_VERSION))
    return df.select(
        F.col("event"),
        epoch_of(p("time")).alias("timestamp"),
        p("distinct_id").alias("distinct_id"),
        falsy_coalesce(p("$device_id"), p("device_id")).alias("device_id"),
        p("mp_country_code").alias("country_code"),
        falsy_coalesce(p("$city"), p("city")).alias("city"),
        falsy_coalesce(p("$region"), p("region")).alias("region"),
        falsy_coalesce(p("$screen_height"), p("screen_height")).alias("screen_height"),
        falsy_coalesce(p("$screen_width"), p("screen_width")).alias("screen_width"),
        route.alias("current_route"),
        platform.alias("platform"),
        app.alias("app_version"),
        p("recipe_id").alias("recipe_id"),
    )


def add_derived_columns(df: DataFrame) -> DataFrame:
    """Cleaned event name, device type, time of day, weekday and weekend flag."""
    ts = F.timestamp_seconds(F.col("timestamp"))
    return df.withColumns({
        "event": clean_event_name(F.col("event")),
        "device_type": device_type(F.col("screen_height"), F.col("screen_width")),
        "time_of_day": time_of_day(ts),
        "day_of_week": day_of_week(ts),
        "is_weekend": is_weekend(ts),
    })


def select_combined(df: DataFrame) -> DataFrame:
    """Fixed column order of the combined events table."""
    return df.select(*COMBINED_COLUMNS)


def extract_interactions(parsed: DataFrame, version: str, weights: dict | None = None) -> DataFrame:
    """Recipe interactions from parsed raw events.

    Kept: names containing 'Recipe' that are in the weight table, with a non-empty item
    id, a user (top-level ``distinct_id`` else the property) and a time (property
    ``time`` else top-level ``timestamp``). ``rating`` = event weight; device type and
    platform (``$os``) default to 'unknown'; optional ingredient counts pass through.
    """
    from plateau.config import INTERACTION_WEIGHTS
    from plateau.functions.common import weight_of
    p = lambda k: F.col("properties").getField(k)
    w = weight_of(F.col("event"), weights or INTERACTION_WEIGHTS)
    user = F.coalesce(F.col("distinct_id"), p("distinct_id"))
    ts = F.coalesce(epoch_of(p("time")), epoch_of(F.col("timestamp")))
    rid = p("recipe_id")
    keep = (F.col("event").contains("Recipe") & w.isNotNull() & rid.isNotNull() & (rid != "")
            & user.isNotNull() & (user != "") & ts.isNotNull() & (ts != 0))
    return parsed.filter(keep).select(
        user.alias("user_id"), rid.cast("string").alias("recipe_id"), F.col("event").alias("event_type"),
        w.alias("rating"), ts.alias("timestamp"), F.lit(version).alias("version"),
        F.coalesce(p("device_type"), F.lit("unknown")).alias("device_type"),
        F.coalesce(p("$os"), F.lit("unknown")).alias("platform"),
        p("total_ingredients").try_cast("int").alias("recipe_total_ingredients"),
        p("owned_ingredients").try_cast("int").alias("user_owned_ingredients"),
        F.timestamp_seconds(ts).alias("datetime"))
