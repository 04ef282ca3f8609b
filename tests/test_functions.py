"""Column functions on literal edge cases."""

from pyspark.sql import functions as F

from plateau.functions import events as EV
from plateau.functions import text as TX
from plateau.functions.calendar import day_of_week, is_weekend, time_of_day
from plateau.functions.hashing import hash_bucket


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_clean_event_name(spark):
    got = one(spark, EV.clean_event_name(F.col("e")),
              [(None,), ("",), ("$ae_first_open",), ("$ae_session",), ("$identify",), ("Recipe Viewed",)], "e string")
    assert got == ["Unknown Event", "Unknown Event", "First Open", "Session", "User Identified", "Recipe Viewed"]


def test_device_type(spark):
    rows = [("1024", "10"), ("800", "600"), ("abc", "100"), (None, "2000"), ("0", "1100"), ("1024.5", "10")]
    got = one(spark, EV.device_type(F.col("h"), F.col("w")), rows, "h string, w string")
    assert got == ["tablet", "mobile", "unknown", "unknown", "tablet", "unknown"]


def test_falsy_coalesce(spark):
    got = one(spark, EV.falsy_coalesce("a", "b"), [("", "x"), (None, "y"), ("0", "z"), ("v", "w")], "a string, b string")
    assert got == ["x", "y", "z", "v"]


def test_resolve_platform(spark):
    rows = [("web", None, None), (None, "react-native", "iOS 17"), (None, "react-native", "Android"),
            (None, "react-native", "Windows"), (None, None, None), ("", "swift", None)]
    got = one(spark, EV.resolve_platform(F.col("p"), F.col("m"), F.col("o")), rows, "p string, m string, o string")
    assert got == ["web", "ios", "android", "mobile", "unknown", "swift"]


def test_item_id_from_route(spark):
    rows = [("/recipes/42",), ("/recipes/42/steps",), ("/recipes/7?x=1",), ("/recipes/[id]",), ("/home",), (None,)]
    assert one(spark, EV.item_id_from_route(F.col("r")), rows, "r string") == ["42", "42", "7", "unknown", "unknown", "unknown"]


def test_calendar(spark):
    rows = [("2024-01-06 08:00:00",), ("2024-01-08 13:00:00",), ("2024-01-09 18:30:00",), ("2024-01-10 23:00:00",), (None,)]
    ts = F.col("t").cast("timestamp")
    assert one(spark, time_of_day(ts), rows, "t string") == ["morning", "afternoon", "evening", "night", "unknown"]
    assert one(spark, day_of_week(ts), rows, "t string") == ["Saturday", "Monday", "Tuesday", "Wednesday", "unknown"]
    assert one(spark, is_weekend(ts), rows, "t string") == [True, False, False, False, None]


def test_parse_minutes_and_servings(spark):
    rows = [("1h 30m",), ("1h",), ("1.5h",), ("30m",), ("30",), ("",), ("soon",), (None,), ("45.9",)]
    assert one(spark, TX.parse_minutes(F.col("s")), rows, "s string") == [90, 60, 90, 30, 30, None, None, None, 45]
    srv = [("4",), ("2.7",), ("abc",), (None,), (" 6 ",)]
    assert one(spark, TX.parse_servings(F.col("s")), srv, "s string") == [4, 2, None, None, 6]


def test_parse_and_sanitize_tags(spark):
    rows = [('["Main", " Quick ", ""]',), ("a, b | c",), ("one two  three",), ("",), (None,), ("[broken",)]
    got = one(spark, TX.parse_tags(F.col("t")), rows, "t string")
    assert got == [["Main", "Quick"], ["a", "b", "c"], ["one", "two", "three"], [], [], ["[broken"]]
    san = one(spark, TX.sanitize_tag(F.col("t")), [("Low-Fat & Tasty!",), ("__x__",), ("A" * 50,)], "t string")
    assert san == ["low_fat_tasty", "x", "a" * 40]


def test_preview_truncate_list(spark):
    assert one(spark, TX.tags_preview(F.col("t")), [("['a', 'b', 'c', 'd', 'e', 'f']",)], "t string") == ["a, b, c, d, e"]
    assert one(spark, TX.truncate_text(F.col("t"), 5), [("abcdefg",), ("abc",)], "t string") == ["abcde...", "abc"]
    assert one(spark, TX.parse_list(F.col("t")), [("['x', 'y']",)], "t string") == [["x", "y"]]


def test_hash_bucket_is_stable(spark):
    a = one(spark, hash_bucket(F.col("u"), 3), [("u1",), ("u2",), ("u1",)], "u string")
    assert a[0] == a[2] and all(0 <= x < 3 for x in a)


def test_tokens_and_ngrams(spark):
    got = one(spark, TX.ngrams_1_2(TX.tokens(F.col("t"))), [("Red hot  chili a",), ("x",), (None,)], "t string")
    assert got == [["red", "hot", "chili", "red hot", "hot chili"], [], []]
