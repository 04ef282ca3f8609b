"""Profiles, pairs, negatives and splits: literal cases and properties."""

import hashlib
import re
from datetime import datetime

from pyspark.sql import functions as F

from plateau import session
from plateau.operators import features as FE
from plateau.operators.content import top_ingredients, user_features, user_item_features
from plateau.operators.pairs import eligible_pairs, negative_samples, positive_pairs
from plateau.operators.profiles import user_profiles
from plateau.operators.splits import row_at, stratified_split, temporal_split
from plateau.sources import fixtures as X
from tests.conftest import SF


def test_profile_rounding_std_and_mode(spark):
    rows = [("u", "a", 0.0625, "2024-01-01 00:00:00", "phone", "ios"),
            ("v", "a", 1.0, "2024-01-01 00:00:00", "tablet", None),
            ("v", "b", 2.0, "2024-01-03 12:00:00", "phone", None)]
    df = spark.createDataFrame(rows, "user_id string, recipe_id string, rating double, d string, device_type string, "
                                     "platform string").withColumn("datetime", F.col("d").cast("timestamp"))
    p = {r.user_id: r for r in user_profiles(df).collect()}
    assert p["u"].avg_rating == 0.062 and p["u"].rating_std == 0.0 and p["u"].activity_days == 1
    assert p["v"].primary_device == "phone" and p["v"].primary_platform == "unknown"  # tie -> smallest
    assert p["v"].activity_days == 3 and p["v"].unique_recipes == 2


def test_best_event_and_label(spark):
    rows = [("u", "r", "Recipe Viewed", 1.0, 1), ("u", "r", "Recipe Cooked", 5.0, 2), ("u", "r", "Recipe Cooked", 5.0, 3),
            ("u", "s", "Recipe Removed From Collections", -2.0, 4), ("u", "t", "Odd Event", None, 5)]
    df = spark.createDataFrame(rows, "user_id string, recipe_id string, event_type string, rating double, seq long") \
        .withColumn("datetime", F.current_timestamp()).withColumn("version", F.lit("v1"))
    got = {r.recipe_id: (r.event_type, r.label) for r in positive_pairs(df).collect()}
    assert got == {"r": ("Recipe Cooked", 5.0), "s": ("Recipe Removed From Collections", 0.1), "t": ("Odd Event", 1.0)}


def test_negatives_properties(spark):
    inter = X.interactions_small(spark, SF)
    cat = X.catalog_raw(spark, SF)
    pos = positive_pairs(inter)
    neg = negative_samples(pos, cat, 4, 42)
    assert neg.join(pos, ["user_id", "recipe_id"]).count() == 0  # disjoint from positives
    assert neg.groupBy("user_id", "recipe_id").count().filter("count > 1").count() == 0  # distinct
    n_items = cat.count()
    per = neg.groupBy("user_id").count().withColumnRenamed("count", "neg")
    npos = pos.groupBy("user_id").count().withColumnRenamed("count", "npos")
    for r in per.join(npos, "user_id").collect():
        assert r.neg == min(4 * r.npos, n_items - r.npos)  # every positive item is in the catalog here
    again = negative_samples(pos, cat, 4, 42)
    assert again.exceptAll(neg).count() == 0  # deterministic


def test_eligibility_rule(spark):
    pairs = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 5.0), ("c", "z", 1.0)], "user_id string, recipe_id string, label double")
    inter = spark.createDataFrame([("a",), ("b",)], "user_id string")
    assert {r.user_id for r in eligible_pairs(pairs, inter, "eq1").collect()} == {"a"}
    assert {r.user_id for r in eligible_pairs(pairs, inter, "gt0").collect()} == {"a", "b"}


def test_splits_partition_input(spark):
    inter = X.interactions_small(spark, SF)
    pos = positive_pairs(inter)
    s = stratified_split(pos)
    assert s.count() == pos.count()
    counts = {(r.label, r.split): r["count"] for r in s.groupBy("label", "split").count().collect()}
    for lab in {k[0] for k in counts}:
        n = sum(v for (lb, _), v in counts.items() if lb == lab)
        assert counts.get((lab, "test"), 0) == int(n * 0.2)
    t = temporal_split(pos)
    n = pos.count()
    c = {r.split: r["count"] for r in t.groupBy("split").count().collect()}
    assert c.get("test", 0) == int(0.2 * n) and c.get("val", 0) == int(0.2 * n)
    last_train = t.filter("split = 'train'").agg(F.max("datetime")).first()[0]
    first_test = t.filter("split = 'test'").agg(F.min("datetime")).first()[0]
    assert last_train <= first_test


def _walk(seed, user, n_items, p, touched, m):
    """The first m untouched indexes of a user's permutation, position by position."""
    h = lambda *x: int(hashlib.md5("|".join(x).encode()).hexdigest()[:8], 16)
    a, b, out, j = 1 + h(str(seed), "a", user) % (p - 1), h(str(seed), "b", user) % p, [], 0
    while len(out) < m:
        i = (a * j + b) % p
        if i < n_items and i not in touched:
            out.append(i)
        j += 1
    return out


def test_negatives_are_the_walk_and_draw_nothing_in_vain(spark):
    n = 90  # the next prime is 97
    ids = [f"i{k}" for k in range(n)]
    cat = spark.createDataFrame([(x,) for x in ids], "recipe_id string")
    own = {"light": ids[:3], "half": ids[10:45], "all": ids, "nearly": ids[:-1], "gone": ["x", "y"], "one": ["x", ids[7]]}
    pos = spark.createDataFrame([(u, r) for u, rs in own.items() for r in rs] + [(None, "i1"), ("one", None)], "user_id string, recipe_id string")
    held = len(session._HELD)
    neg = negative_samples(pos, cat, 4, 42, chunk=8)
    assert len(session._HELD) == held and "LeftAnti" not in neg._jdf.queryExecution().toString()  # no candidate table
    order = sorted(ids, key=lambda x: (f"{int(hashlib.md5(f'42|{x}'.encode()).hexdigest()[:8], 16):010d}|{x}"))
    want = set()
    for u, rs in own.items():
        touched = {order.index(r) for r in rs if r in order}
        m = min(4 * (len(rs) + (u == "one")), n - len(touched))
        want |= {(u, order[i]) for i in _walk(42, u, n, 97, touched, m)}
    got = [(r.user_id, r.recipe_id) for r in neg.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_temporal_cuts_without_moving_rows(spark):
    rows = [(f"u{k % 7}", f"r{k % 11}", None if k % 3 else datetime(2024, 1, 1 + k % 5)) for k in range(200)]
    df = spark.createDataFrame(rows, "user_id string, recipe_id string, datetime timestamp")
    key = lambda r: (r[2] is None, r[2] or datetime.min, r[0], r[1])
    srt = sorted(rows, key=key)
    out = temporal_split(df)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():      # rows that tie with a cut row go the way of the rows after it or before it together
        k = key((r.user_id, r.recipe_id, r.datetime))
        assert r.split == ("test" if k > key(srt[159]) else "val" if k > key(srt[119]) else "train")
    at = row_at(df.withColumn("_last", F.col("datetime").isNull()), ["_last", "datetime", "user_id", "recipe_id"], 160)
    assert (at["_last"], at["datetime"] or datetime.min, at["user_id"], at["recipe_id"]) == key(srt[159])


def test_no_exchange_of_pairs_carries_the_users_sets(spark):
    inter = spark.createDataFrame([("u", "a", "Recipe Cooked", 5.0, 1), ("u", "b", "Recipe Viewed", 1.0, 2), ("v", "c", "Recipe Viewed", 1.0, 3)],
                                  "user_id string, recipe_id string, event_type string, rating double, seq long").withColumns(
        {"datetime": F.lit("2024-01-02").cast("timestamp"), "device_type": F.lit("phone"), "platform": F.lit("ios"), "version": F.lit("v1")})
    cat = spark.createDataFrame([(x, "A" if x < "c" else None, 10.0) for x in "abcd"], "recipe_id string, author_name string, total_time double")
    bridge = spark.createDataFrame([("a", 1), ("a", 70), ("b", 70), ("b", 2), ("d", 70), ("d", 900)], "recipe_id string, ingredient_id long")
    pairs = spark.createDataFrame([("u", "a", 5.0, 5.0), ("u", "d", 0.0, 0.0), ("v", "a", 0.0, 0.0)],
                                  "user_id string, recipe_id string, rating double, label double").withColumn("datetime", F.lit(None).cast("timestamp"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = FE.training_features(pairs, user_profiles(inter), FE.catalog_features(cat, bridge), bridge, inter, do_impute=False)
        plan = t._jdf.queryExecution().optimizedPlan().toString().split("\n")
        # the users' side, which holds the sets, is the right side of the outermost join: its output is never joined again
        joins = [(len(x) - len(x.lstrip(" :+-")), x) for x in plan if "Join LeftOuter" in x]
        assert "user_id" in min(joins)[1] and "recipe_id" not in min(joins)[1]
        got = {(r.user_id, r.recipe_id): (r.ingredient_overlap_count, r.ingredient_similarity_score, r.user_author_interaction_count, r.author_affinity_score)
               for r in t.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert got == {("u", "a"): (2, 2 / 3, 2, 2 / 3), ("u", "d"): (1, 1 / 4, 0, 0.0), ("v", "a"): (0, 0.0, 0, 0.0)}


def test_top_ingredients_open_their_lists_at_the_user(spark):
    ings = spark.createDataFrame([("a", "salt"), ("a", "oil"), ("a", "oil"), ("b", "oil"), ("b", None), ("c", "egg")], "recipe_id string, ingredient string")
    inter = spark.createDataFrame([("u", "a"), ("u", "a"), ("u", "b"), ("v", "c"), (None, "c"), ("w", None), ("v", "x")], "user_id string, recipe_id string")
    top = top_ingredients(inter, ings, 2)
    assert sorted(map(tuple, top.collect()), key=str) == sorted([("u", "oil", 1), ("u", "salt", 2), ("v", "egg", 1), (None, "egg", 1)], key=str)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan and "Generate explode(_list" in plan
    assert not any("Exchange hashpartitioning(user_id" in x and "ingredient" in x.split("]")[0] for x in plan.split("\n"))


def _content(spark):
    ings = spark.createDataFrame([("a", "salt"), ("a", "oil"), ("b", "oil"), ("b", None), ("c", "egg")], "recipe_id string, ingredient string")
    items = spark.createDataFrame([("a", "ann", "10 min", ["main", "quick"]), ("b", None, None, None), ("d", "bob", "1 h", ["main", None])],
                                  "recipe_id string, recipe_author string, recipe_cooking_time string, recipe_tags array<string>")
    inter = spark.createDataFrame([("u", "a", 2.0, 0, ["Recipe Viewed"]), ("u", "b", 4.0, 90000, ["Recipe Cooked"]), ("v", "c", 1.0, 5, []),
                                   (None, "c", 1.0, 5, []), ("w", "d", 3.0, 5, ["Recipe Viewed"]), ("x", None, 3.0, 5, [])],
                                  "user_id string, recipe_id string, rating double, timestamp long, event array<string>")
    return inter, items, ings


def test_user_features_open_an_items_lists_at_the_user(spark):
    inter, items, ings = _content(spark)
    uf = user_features(inter, items, ings)
    assert {r.user_id: r.avg_ingredient_count for r in uf.collect()}["u"] == 1.5             # a NULL name is no ingredient
    got = {r.user_id: (r.top_cuisine, r.cuisine_diversity, r.top_author, r.author_loyalty, r.top_ingredient, r.ingredient_diversity)
           for r in uf.collect() if r.user_id}
    assert got == {"u": ("main", 2, "", 0.5, "oil", 2), "v": ("main", 0, "", 1.0, "egg", 1),
                   "w": ("main", 1, "bob", 1.0, "unknown", 0), "x": ("main", 0, "", 1.0, "unknown", 0)}
    plan = uf._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\((user_id[^)]*)\)", plan)
    assert keys and all(re.fullmatch(r"user_id#\d+, \d+", k) for k in keys), keys


def test_user_item_features_exchange_no_row_per_ingredient(spark):
    inter, items, ings = _content(spark)
    top = spark.createDataFrame([("u", "oil", 1), ("u", None, 2), ("v", "egg", 1)], "user_id string, ingredient string, rank int")
    itf = spark.createDataFrame([("a", 1.0, 2, 1, "main", "ann", 3.0, 1.0, 1.0)],
                                "recipe_id string, complexity_score double, ingredient_count long, is_quick long, primary_tag string, "
                                "recipe_author string, avg_rating double, days_since_first double, days_since_last double")
    out = user_item_features(inter.select("user_id", "recipe_id", "rating"), user_features(inter, items, ings), itf, top, ings)
    assert out.columns[:3] == ["user_id", "recipe_id", "rating"]
    got = {(r.user_id, r.recipe_id): (r.ingredient_overlap_count, r.ingredient_jaccard, r.has_familiar_ingredients) for r in out.collect()}
    assert got == {("u", "a"): (1, 1 / 3, 1), ("u", "b"): (1, 1 / 3, 1), ("v", "c"): (1, 1.0, 1), (None, "c"): (0, 0.0, 0),
                   ("w", "d"): (0, 0.0, 0), ("x", None): (0, 0.0, 0)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "user_id, ingredient" not in plan and "ingredient, user_id" not in plan


def test_ingredient_sets_exchange_no_row_per_user_and_ingredient(spark):
    from plateau.operators.features import ingredient_sets
    inter = spark.createDataFrame([("u", "a", 1.0), ("u", "b", 2.0), ("u", "a", 3.0), ("v", "b", -1.0), ("w", "a", 1.0), ("x", "z", 1.0), (None, "a", 1.0)],
                                  "user_id string, recipe_id string, rating double")
    bridge = spark.createDataFrame([("a", 10), ("a", 11), ("a", 11), ("a", None), ("b", 11), ("b", 200), (None, 10)], "recipe_id string, ingredient_id long")
    us, rs = ingredient_sets(inter, bridge)
    assert {r.user_id: (r._nu, r._um) for r in us.collect()} == {"u": (3, {0: 14}), "w": (2, {0: 6}), None: (2, {0: 6})}  # index 0 is NULL
    assert {r.recipe_id: (r._nr, r._ri) for r in rs.collect() if r.recipe_id} == {"a": (2, [1, 2]), "b": (2, [2, 3])}
    plan = us._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(user_id#\d+, (ingredient_id|w)#", plan)
