"""Shapes of raw events that must not cost a line or a field, and the checkpoint folder's rule."""

import pytest

from plateau.operators.splits import stratified_split, temporal_split
from plateau.session import checkpoint_dir
from plateau.sources.events import extract_interactions, parse_event_lines

LINE = '{"event": "Recipe Viewed", "distinct_id": "u", "properties": {"time": %s, "recipe_id": "7", "total_ingredients": %s, "recipe_tags": %s}}'


def test_times_and_counts_of_any_json_type(spark):
    lines = [LINE % ("1704528000", "5", "[]"), LINE % ("1704528000.5", '"6"', '"a,b"'), LINE % ('"1704528000"', "null", "{}"),
             LINE % ('"soon"', "1", "1"), "", "  ", "[1, 2]", '"text"', '{"event": "Recipe Viewed"', "nonsense",
             '{"event": "Recipe Viewed", "properties": "none"}', '  {"event": null, "properties": {"time": 1}}', '\t{"event": "Tabbed"}', "\t\t"]
    df = parse_event_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert df.count() == 7
    got = sorted((r.timestamp, r.recipe_total_ingredients or 0) for r in extract_interactions(df, "v1").collect())
    assert got == [(1704528000.0, 0), (1704528000.0, 5), (1704528000.5, 6)]


def test_checkpoint_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_splits_against_sorted_rows(spark):
    import hashlib
    rows = [(f"u{i % 7}", f"r{i}", [1.0, 1.0, 1.0, 0.1, None][i % 5], None if i % 11 == 0 else i % 13) for i in range(400)]
    df = spark.createDataFrame(rows, "user_id string, recipe_id string, label double, datetime long")

    def h(r):
        return int(hashlib.md5(f"42|{r[0]}|{r[1]}".encode()).hexdigest()[:8], 16)
    want = {}
    for label in {r[2] for r in rows}:
        g = sorted((r for r in rows if r[2] == label), key=lambda r: (h(r), r[0], r[1]))
        n = int(len(g) * .2)
        want |= {r[:2]: "test" if k < n else "val" if k < 2 * n else "train" for k, r in enumerate(g)}
    got = {(r.user_id, r.recipe_id): r.split for r in stratified_split(df).collect()}
    assert got == want
    g = sorted(rows, key=lambda r: (r[3] is None, r[3] or 0, r[0], r[1]))
    want = {r[:2]: "test" if k >= 320 else "val" if k >= 240 else "train" for k, r in enumerate(g)}
    assert {(r.user_id, r.recipe_id): r.split for r in temporal_split(df).collect()} == want
