"""Joins of the large tables: dealt by their rows, and read once by the jobs that need them once."""

from plateau.plans import registry
from plateau.sources import fixtures as X


def _tables(spark, at):
    spark.sql("SELECT id AS o_orderkey, id % 7 AS o_custkey, timestamp_ntz'2024-01-01' AS o_orderdate FROM range(30)").write.parquet(f"{at}/orders.parquet")
    spark.sql("SELECT if(id % 10 = 0, NULL, id % 40) AS l_orderkey, id % 9 AS l_partkey, CAST(id % 4 AS INT) AS l_linenumber, 'A' AS l_returnflag, "
              "if(id % 2 = 0, 'F', 'O') AS l_linestatus FROM range(100)").write.parquet(f"{at}/lineitem.parquet")
    return str(at)


def test_interactions_are_dealt_into_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    registry.load_all()
    d = _tables(spark, tmp_path)
    few = X.interactions_large(spark, d)
    monkeypatch.setattr(X, "_JOIN_ROWS", 5)
    many = X.interactions_large(spark, d)
    assert "REPARTITION_BY_NUM" not in few._jdf.queryExecution().executedPlan().toString()
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(l_orderkey") == plan.count("hashpartitioning(o_orderkey") == 1
    assert plan.count(", 20), REPARTITION_BY_NUM") == 2
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())) and many.count() == 72
    u04 = registry.QUERIES["U04_distinct_items"](spark, d)
    assert sorted(map(tuple, u04.collect())) == sorted({(r.recipe_id, r.event_type) for r in few.collect()})


def test_item_features_read_the_interactions_once(spark):
    from plateau import session
    from plateau.operators.content import item_features
    registry.load_all()
    inter = spark.createDataFrame([("u", "a", 2.0, 10), ("v", "a", 4.0, 20), ("v", "b", None, 5)], "user_id string, recipe_id string, rating double, timestamp long")
    items = spark.createDataFrame([("a", "n", "x", "v1", "1h", "2", ["main"]), ("c", "n", None, "v2", "", "", ["light"])],
                                  "recipe_id string, recipe_name string, recipe_author string, version string, recipe_cooking_time string, recipe_servings string, recipe_tags array<string>")
    ings = spark.createDataFrame([("a", "oil")], "recipe_id string, ingredient string")
    out = item_features(items, ings, inter, 86400)
    assert {(r.recipe_id, r.interaction_count, r.avg_rating, r.is_popular) for r in out.collect()} == {("a", 2, 3.0, 1), ("c", 0, 2.5, 0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation [recipe_id" in plan and "interaction_count" in plan
    session.release()
    registry.QUERIES["F06_item_features"](spark, "/root/testdata/sf0.001")
    assert session._HELD and not any("event" in df.columns or "ingredient" in df.columns for df in session._HELD)
    session.release()


def _small_job(spark):
    from pyspark.sql import functions as F
    inter = spark.createDataFrame([("u", "a", "Recipe Cooked", 5.0, 1), ("u", "b", "Recipe Viewed", 1.0, 2), ("v", "c", "Recipe Cooked", 5.0, 3),
                                   (None, "a", "Recipe Viewed", 1.0, 4), ("w", "a", "Recipe Viewed", 1.0, 5), ("w", None, "Recipe Viewed", 1.0, 6)],
                                  "user_id string, recipe_id string, event_type string, rating double, seq long").withColumns(
        {"datetime": F.lit("2024-01-02").cast("timestamp"), "device_type": F.lit("phone"), "platform": F.lit("ios"), "version": F.lit("v1")})
    cat = spark.createDataFrame([(x, f"name {x}", "A" if x < "c" else None, 10.0, None) for x in "abcdefgg"],
                                "recipe_id string, recipe_name string, author_name string, total_time double, servings long")
    bridge = spark.createDataFrame([("a", 1), ("a", 70), ("b", 70), ("b", 2), ("d", 70), ("d", 900)], "recipe_id string, ingredient_id long")
    return inter, cat, bridge


def test_pairs_of_eligible_users_are_drawn_without_an_exchange_of_all_pairs(spark):
    from plateau.operators.pairs import eligible_pairs, user_item_pairs
    inter, cat, _ = _small_job(spark)
    for rule in ("eq1", "gt0"):
        all_pairs = eligible_pairs(user_item_pairs(inter, cat, 2, 42), inter, rule)
        few = user_item_pairs(inter, cat, 2, 42, rule=rule)
        assert few.columns == all_pairs.columns
        assert sorted(map(str, few.collect())) == sorted(map(str, all_pairs.collect())) and few.count()
        assert "LeftSemi" not in few._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_meet_both_sides_in_one_narrow_exchange(spark, monkeypatch):
    from plateau import session
    from plateau.operators import features as FE
    pairs = spark.createDataFrame([(u, r, float(k)) for k, (u, r) in enumerate((u, r) for u in ("u", "v", None, "x") for r in ("a", "b", "g", None, "z"))],
                                  "user_id string, recipe_id string, label double")
    items = spark.createDataFrame([("a", "long text", [1, 2]), ("b", None, None), ("g", "one", [3]), ("g", "two", [4]), (None, "none", [5])],
                                  "recipe_id string, text string, list array<int>")
    users = spark.createDataFrame([("u", {1: 2}), ("v", None), (None, {5: 6})], "user_id string, words map<int,long>")
    history = spark.createDataFrame([("u", "a", 7), ("v", "g", 8), (None, "a", 9)], "user_id string, recipe_id string, n int")
    want = pairs.join(history, ["user_id", "recipe_id"], "left").join(items, "recipe_id", "left").join(users, "user_id", "left")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows, size in ((100_000, 64 << 20), (1, 64 << 20), (2, 30)):
            monkeypatch.setattr(FE, "CELL_ROWS", rows)
            monkeypatch.setattr(FE, "CELL_BYTES", size)
            got = FE.meet(pairs, items, users, history)
            assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
            plan = got._jdf.queryExecution().executedPlan().toString()
            deals = [x for x in plan.split("\n") if "Exchange hashpartitioning(" in x]
            assert len(deals) == 4 and all("REPARTITION_BY_NUM" in x and "hashpartitioning(_cell" in x for x in deals)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    monkeypatch.undo()
    assert FE._shape((10, 0), (10, 0))[0] * FE._shape((10, 0), (10, 0))[1] >= FE._CELLS
    assert FE._shape((900_000, 9 << 27), (1_200_000, 6 << 27)) == (18, 12)
    session.release()


def test_the_text_step_sends_no_feature_row_to_its_item(spark, tmp_path):
    from plateau import session
    from plateau.operators import features as FE
    from plateau.operators.text import Encoder
    from plateau.plans import training_data as TD
    inter, cat, bridge = _small_job(spark)
    enc = (Encoder("author_name", "freq", "author_freq"), Encoder("recipe_name", "hashing", "name_hash_", 4))
    inter = inter.filter("recipe_id IS NOT NULL")
    td = TD.build_training_data(inter, cat, bridge, encoders=enc)
    plan = td.features._jdf.queryExecution().optimizedPlan().toString()
    joins = [(len(x) - len(x.lstrip(" :+-")), x) for x in plan.split("\n") if "Join " in x]
    assert "_cell" in sorted(joins)[1][1], plan          # below the cut's join the cells follow at once
    plain = TD.build_training_data(inter, cat, bridge).features
    want = plain.join(td.encoded, "recipe_id", "left")
    assert td.features.columns == want.columns
    assert sorted(map(str, td.features.collect())) == sorted(map(str, want.collect()))
    seen = TD.write_training_data(td, str(tmp_path / "out"))
    assert seen["rows"] == want.count() and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    session.release()


def test_stored_rows_outlive_one_release(spark):
    from plateau import session
    from plateau.sources.io import path_exists
    session.release()
    rows = session.store(spark.range(10))
    path = session._STORED[-1][-1][1]
    session.release()
    assert rows.count() == 10
    session.release()
    assert not path_exists(spark, path)
