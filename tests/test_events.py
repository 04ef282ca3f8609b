"""Raw event scan and cleaning on the literal cases of the raw-event format."""

import json

from plateau.plans.clean_events import combined_events_from_lines
from plateau.sources.events import parse_event_lines


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_clean_events_edge_cases(spark):
    v1 = [
        "",
        '{"event": "Recipe Viewed", "properties": {"time": 1704528000, "distinct_id": "u1", "$city": "", '
        '"city": "Oslo", "$screen_height": 0, "screen_height": "1200", "$screen_width": "700", "recipe_id": 42}}',
        '{"event": "broken", ',
    ]
    v2 = [
        json.dumps({"event": "Recipe Cooked", "distinct_id": "top", "properties": {
            "time": 1704614400, "distinct_id": "u2", "is_development": True}}),
        json.dumps({"event": "$identify", "properties": {
            "time": 1704700800, "distinct_id": "u3", "is_development": False, "mp_lib": "react-native",
            "$os": "Android", "$screen_height": "abc", "$screen_width": "100", "current_route": "/recipes/9"}}),
        json.dumps({"event": "Recipe Viewed", "properties": {"distinct_id": "u4", "recipe_id": "77",
                                                              "$app_version_string": "3.1"}}),
    ]
    out = combined_events_from_lines(lines(spark, v1), lines(spark, v2)).orderBy("distinct_id").collect()
    assert [r.distinct_id for r in out] == ["u1", "u3", "u4"]  # blank, broken and dev rows dropped
    u1, u3, u4 = out
    assert (u1.city, u1.screen_height, u1.device_type, u1.platform, u1.app_version, u1.recipe_id) == \
        ("Oslo", "1200", "tablet", "ios", "1.0.0", "42")
    assert (u1.time_of_day, u1.day_of_week, u1.is_weekend, u1.current_route) == ("morning", "Saturday", True, "")
    assert (u3.event, u3.platform, u3.device_type, u3.current_route) == ("User Identified", "android", "unknown", "/recipes/9")
    assert (u4.app_version, u4.timestamp, u4.time_of_day, u4.day_of_week, u4.is_weekend) == \
        ("3.1", None, "unknown", "unknown", None)


def test_a_line_is_made_once(spark):
    """A line that an expression makes is not made again by the filters over it."""
    made = spark.createDataFrame([("{}",), ("none",)], "x string").selectExpr("reverse(reverse(x)) AS value")
    parsed = parse_event_lines(made)
    assert parsed.count() == 1
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("reverse(reverse(") == 1


def test_raw_lines_are_put_together_in_parts(spark, tmp_path):
    """No projection holds all properties: their method would be too long for the JVM to compile."""
    from plateau.sources.fixtures import raw_event_lines
    rows = "SELECT id AS event_id, id AS user_id, 'view' AS event_type, 1.5D AS value, '{\"k\": 7}' AS props, timestamp_ntz'2024-01-01' AS ts FROM range(1, 12)"
    spark.sql(rows).write.parquet(f"{tmp_path}/events.parquet")
    lines = raw_event_lines(spark, str(tmp_path), "v2")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert not any("total_ingredients" in x and "distinct_id" in x for x in plan.splitlines())
    out = {json.loads(r.value)["properties"]["distinct_id"]: json.loads(r.value)["properties"] for r in lines.collect()}
    assert len(out) == 6 and out["u3"]["recipe_id"] == 7 and out["u5"]["recipe_id"] == "7" and out["u3"]["recipe_url"] == "http://shop.example/item/7"


def test_funnel_reads_its_events_once(spark):
    from plateau.operators.explore import funnel
    rows = [("Recipe Viewed", "a"), ("Recipe Viewed", "a"), ("Recipe Cooked", "a"), ("Recipe Viewed", "b"), ("Other", "c"),
            ("Recipe Viewed", None), (None, "d")]
    f = funnel(spark.createDataFrame(rows, "event string, distinct_id string"))
    assert [(r.step, r.event, r.users, r.percentage) for r in f.orderBy("step").collect()] == [
        (0, "Recipe Viewed", 3, 75.0), (1, "Recipe Favourited", 0, 0.0), (2, "Recipe Cooked", 1, 25.0)]
    assert f._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
