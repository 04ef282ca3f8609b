"""The streaming event-cleaning job gives the same rows as the batch plan."""

import json
import uuid

from plateau.plans.clean_events import combined_events_from_lines
from plateau.session import checkpoint_dir
from plateau.streaming.events_stream import start_clean_events

V1 = ["", '{"event": "Recipe Viewed", "properties": {"time": 1704528000, "distinct_id": "a", "recipe_id": 1}}',
      '{"event": "broken"']
V2 = [json.dumps({"event": "$ae_session", "properties": {"time": 1704614400, "distinct_id": "b",
                                                          "mp_lib": "react-native", "$os": "iOS"}}),
      json.dumps({"event": "Recipe Cooked", "properties": {"time": 1704614401, "distinct_id": "c",
                                                            "is_development": True}})]


def _write(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def test_stream_equals_batch(spark):
    base = f"{checkpoint_dir(spark).rstrip('/')}/test-stream-{uuid.uuid4().hex}"
    _write(spark, f"{base}/v1", V1)
    _write(spark, f"{base}/v2", V2)
    q = start_clean_events(spark, f"{base}/v1", f"{base}/v2", f"{base}/out", f"{base}/_ckpt")
    q.awaitTermination()
    streamed = spark.read.parquet(f"{base}/out")
    batch = combined_events_from_lines(spark.read.text(f"{base}/v1"), spark.read.text(f"{base}/v2"))
    assert streamed.count() == 2
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
    assert {r.platform for r in streamed.collect()} == {"ios"}


EVENTS = "distinct_id string, event string, timestamp double"


def test_totals_grow_over_restarts_and_repeated_batches(spark):
    """Totals after a second run on the same state equal the batch summary of all events, nulls included."""
    from plateau.operators.explore import user_summary
    from plateau.streaming import running_totals as RT
    base = f"{checkpoint_dir(spark).rstrip('/')}/test-totals-{uuid.uuid4().hex}"
    first = [("a", "Recipe Viewed", 100.0), ("a", "Session", 90000.0), ("b", "Recipe Viewed", 5.0), (None, "Session", 1.0), ("b", None, 7.0)]
    second = [("a", "Recipe Viewed", 400000.0), ("c", "Recipe Cooked", 3.0), ("a", "Recipe Viewed", 50.0), ("b", None, None)]
    for rows in (first, second):
        spark.createDataFrame(rows, EVENTS).repartition(3).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        RT.start_running_totals(stream, f"{base}/out", f"{base}/_state").awaitTermination()
        last = RT.latest_totals(spark, f"{base}/out")
        n = sum(r["n"] for r in last.collect())
        assert n == (5 if rows is first else 9)                       # the second run goes on from the first one's state
    whole = spark.createDataFrame(first + second, EVENTS)
    pick = ("distinct_id", "total_events", "recipe_events", "first_seen", "last_seen", "days_active")
    keyed = whole.filter("distinct_id IS NOT NULL AND event IS NOT NULL")
    want = sorted(map(tuple, user_summary(keyed).select(*pick).collect()))
    got = RT.summary_of(last.filter("distinct_id IS NOT NULL AND event IS NOT NULL"))
    assert sorted(map(tuple, got.select(*pick).collect())) == want
    a = {r["distinct_id"]: r["event_types"] for r in got.collect()}["a"]
    assert a == {"Recipe Viewed": 3, "Session": 1}


def test_one_scan_report(spark):
    """Every section of the report equals a grouping of its own, nulls included, and the events are read once."""
    from plateau.operators import explore as E
    rows = [("a", "Recipe Viewed", 1704528000.0, "Monday", True, "d1"), ("a", "Recipe Viewed", 1704614400.0, None, None, "d1"),
            ("b", "Session", 1704528001.0, "Monday", True, None), (None, "Recipe Cooked", 1704528000.0, "Friday", False, "d2"),
            *[("c", "Recipe Viewed", 1704528000.0 + 3600 * i, "Sunday", False, "d3") for i in range(7)]]
    ev = spark.createDataFrame(rows, "distinct_id string, event string, timestamp double, day_of_week string, is_weekend boolean, device_id string")
    rep = E.report(E.activity_sets(ev))
    got = {(r["report"], r["key"]): (r["n"], r["users"]) for r in rep.collect()}
    assert got["total", None] == (11, None) and got["users", None] == (None, 3) and got["devices", None] == (None, 3)
    assert got["event", "Recipe Viewed"] == (9, 2) and got["event", "Session"] == (1, 1) and got["event", "Recipe Cooked"] == (1, 0)
    assert ("recipe_event", "Session") not in got and got["recipe_event", "Recipe Viewed"] == (9, 2)
    assert got["weekday", None] == (1, None) and got["weekend", "false"] == (8, None) and got["weekend", None] == (1, None)
    assert got["segment", "Light User"] == (2, 1) and got["segment", "Moderate User"] == (7, 1) and got["segment", "One-time User"] == (2, 2)
    assert got["bucket", "2-5"] == (2, 1) and got["bucket", "6-10"] == (7, 1) and got["bucket", "1"] == (1, 1)
    assert sum(n for (r, _), (n, _) in got.items() if r == "hour") == 11
    assert E.report(E.activity_sets(ev.limit(0))).filter("report <> 'total'").count() == 0
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
