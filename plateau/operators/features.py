"""Feature joins of the training table.

Every join is an equi-join on a key; dimension sides (catalog, bridge statistics,
profiles) are aggregated first so each key appears once. No broadcast hints: AQE turns
a join into a broadcast at run time when the measured side is small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateau.config import (COMPLEXITY_INGREDIENT_DIV, COMPLEXITY_TIME_DEFAULT, COMPLEXITY_TIME_DIV,
                            NO_HISTORY_DAYS, RECENCY_SCALE_DAYS)
from plateau.functions.calendar import whole_days_between
from plateau.operators.pairs import reengagement_stats
from plateau.operators.stats import dense_index, exact_medians, histogram_medians
from plateau.operators.text import add_text_features
from plateau.session import store


def to_number(c) -> Column:
    """Numeric coercion, invalid -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string").try_cast("double")


def bridge_stats(bridge: DataFrame) -> DataFrame:
    """Rows and distinct ingredients per item."""
    return bridge.groupBy("recipe_id").agg(F.count("ingredient_id").alias("ingredient_count"),
                                           F.countDistinct("ingredient_id").alias("unique_ingredients"))


def catalog_features(recipes: DataFrame, bridge: DataFrame) -> DataFrame:
    """Catalog with ingredient counts (0 when absent) and
    ``complexity_score = mean(ingredient_count / 20, coalesce(total_time, 40) / 60)`` (F21, J07)."""
    j = recipes.join(bridge_stats(bridge), "recipe_id", "left")
    return (j.withColumn("ingredient_count", F.coalesce("ingredient_count", F.lit(0)).cast("bigint"))
            .withColumn("unique_ingredients", F.coalesce("unique_ingredients", F.lit(0)).cast("bigint"))
            .withColumn("total_time", to_number("total_time"))
            .withColumn("complexity_score",
                        (F.col("ingredient_count") / COMPLEXITY_INGREDIENT_DIV
                         + F.coalesce("total_time", F.lit(COMPLEXITY_TIME_DEFAULT)) / COMPLEXITY_TIME_DIV) / 2))


def add_bridge_count(pairs: DataFrame, bridge: DataFrame) -> DataFrame:
    """``ingredient_count_db`` = bridge rows per item."""
    c = bridge.groupBy("recipe_id").agg(F.count("ingredient_id").alias("ingredient_count_db"))
    return pairs.join(c, "recipe_id", "left")


def match_features(df: DataFrame) -> DataFrame:
    """User x item compatibility columns."""
    return df.withColumns({
        "user_complexity_match": F.col("avg_rating") * F.col("complexity_score"),
        "user_recipe_engagement_match": F.col("engagement_score") / (F.col("ingredient_count") + 1),
        "user_time_compatibility": F.col("interactions_per_day") / (F.coalesce("total_time", F.lit(30.0)) + 1),
        "is_mobile_user": F.coalesce((F.col("primary_device") == "phone").cast("bigint"), F.lit(0).cast("bigint")),
        "is_ios_user": F.coalesce((F.col("primary_platform") == "ios").cast("bigint"), F.lit(0).cast("bigint")),
    })


def author_counts(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """(user, author) counts over positive interactions."""
    pos = interactions.filter(F.col("rating") > 0).select("user_id", "recipe_id")
    auth = catalog.select("recipe_id", "author_name")
    return (pos.join(auth, "recipe_id", "left").filter(F.col("author_name").isNotNull())
            .groupBy("user_id", "author_name").agg(F.count(F.lit(1)).alias("user_author_interaction_count")))


def author_affinity(df: DataFrame, counts: DataFrame) -> DataFrame:
    """Author affinity columns (F24): count (0 when none), flag, count / (total + 1)."""
    return author_columns(df.join(counts, ["user_id", "author_name"], "left"))


def author_columns(j: DataFrame) -> DataFrame:
    cnt = F.coalesce("user_author_interaction_count", F.lit(0)).cast("bigint")
    return (j.withColumn("user_author_interaction_count", cnt)
            .withColumn("has_interacted_with_author", (F.col("user_author_interaction_count") > 0).cast("bigint"))
            .withColumn("author_affinity_score",
                        F.col("user_author_interaction_count") / (F.col("total_interactions") + 1)))


def reengagement(df: DataFrame, interactions: DataFrame, as_of: str | None = None) -> DataFrame:
    """Re-engagement columns (A04, J06, F25). Without ``as_of`` the recency score is 0
    (the reference's pairs carry no time); with it, days since the last interaction
    (999 when none) and ``1 / (1 + days / 30)``."""
    return history_columns(df.join(reengagement_stats(interactions), ["user_id", "recipe_id"], "left"), as_of)


def history_columns(j: DataFrame, as_of: str | None) -> DataFrame:
    j = j.withColumns({
        "user_recipe_interaction_count": F.coalesce("user_recipe_interaction_count", F.lit(0)).cast("bigint"),
        "user_recipe_max_rating": F.coalesce("user_recipe_max_rating", F.lit(0.0)),
        "user_recipe_avg_rating": F.coalesce("user_recipe_avg_rating", F.lit(0.0)),
    }).withColumn("has_interacted_with_recipe", (F.col("user_recipe_interaction_count") > 0).cast("bigint"))
    if as_of is None:
        return j.withColumn("recipe_recency_score", F.lit(0.0))
    days = F.coalesce(whole_days_between("user_recipe_last_interaction", F.lit(as_of).cast("timestamp")),
                      F.lit(NO_HISTORY_DAYS).cast("bigint"))
    return (j.withColumn("days_since_recipe_interaction", days)
            .withColumn("recipe_recency_score", 1.0 / (1.0 + F.col("days_since_recipe_interaction") / RECENCY_SCALE_DAYS)))


def ingredient_words(rows: DataFrame, key: str) -> DataFrame:
    """(key, _ix) -> (key, w, m): the key's ingredient set as 64-bit words of a
    bitset over the dense ingredient index (only non-empty words are kept)."""
    return rows.groupBy(key, F.floor(F.col("_ix") / 64).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(CAST(1 AS BIGINT), CAST(_ix % 64 AS INT))")).alias("m"))


_USER_ROWS = 50_000  # interactions of a task that opens their items' lists, about


def ingredient_sets(interactions: DataFrame, bridge: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ingredient sets over a dense index: one row per user with a bitset, a word -> mask map (at most
    min(#words, #ingredients) entries, whatever the number of events; columns _um, _nu), and one row per
    item with its indexes as a sorted list (_ri, _nr), which is short where it travels with every pair.
    To a user, too, an item travels as its list, which is opened there: no row per (user, ingredient) is exchanged."""
    ri = bridge.select("recipe_id", "ingredient_id").distinct()
    index = dense_index(ri.select("ingredient_id").distinct(), "ingredient_id", "_ix")
    rs = (ri.join(index, "ingredient_id").groupBy("recipe_id")
          .agg(F.array_sort(F.collect_list(F.col("_ix").cast("int"))).alias("_ri"), F.count(F.lit(1)).alias("_nr")))
    pos = interactions.filter(F.col("rating") > 0).select("user_id", "recipe_id").distinct()
    n = max(int(pos.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-interactions.count() // _USER_ROWS))
    dealt = pos.join(rs, "recipe_id").select("user_id", "_ri").repartition(n, "user_id")
    uw = ingredient_words(dealt.select("user_id", F.explode("_ri").alias("_ix")), "user_id")
    us = uw.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "m"))).alias("_um"),
                                   F.sum(F.bit_count("m")).alias("_nu"))
    return us, rs


def overlap_columns(df: DataFrame) -> DataFrame:
    """Jaccard, overlap and has-common columns (F29) of rows that carry both sets; 0 when either
    set is empty. The overlap counts the item's indexes whose bit the user's words hold."""
    zero = F.lit(0).cast("bigint")
    ov = F.aggregate(F.coalesce("_ri", F.array().cast("array<int>")), zero,
                     lambda acc, x: acc + F.getbit(F.coalesce(F.try_element_at(F.col("_um"), F.shiftright(x, 6)), zero), x.bitwiseAND(F.lit(63))))
    nu, nr = F.coalesce("_nu", F.lit(0)), F.coalesce("_nr", F.lit(0))
    both = (nu > 0) & (nr > 0)
    return (df.withColumn("_ov", ov).withColumns({
        "ingredient_similarity_score": F.when(both, F.col("_ov") / (nu + nr - F.col("_ov"))).otherwise(F.lit(0.0)),
        "ingredient_overlap_count": F.when(both, F.col("_ov")).otherwise(F.lit(0)).cast("bigint"),
        "has_common_ingredients": F.when(both & (F.col("_ov") > 0), 1).otherwise(0).cast("bigint")})
        .drop("_um", "_nu", "_ri", "_nr", "_ov"))


CELL_ROWS = 100_000     # users or items whose rows one cell holds, about
CELL_BYTES = 64 << 20   # what these rows take up, about
_CELLS = 16             # cells at least, if there are as many users and items


def _side(rows: DataFrame) -> tuple[int, int]:
    """Rows of one side and about their bytes: lists and maps by their entries, texts by their length."""
    parts = [F.lit(0)]
    for f in rows.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType
        wide = 8 if isinstance(kind, T.ArrayType) else 40 if isinstance(kind, T.MapType) else 0
        parts.append(8 + (F.greatest(F.size(c), F.lit(0)) * wide if wide else F.length(c) if isinstance(kind, T.StringType) else F.lit(0)))
    size = sum((F.coalesce(x, F.lit(8)) for x in parts[1:]), parts[0]).cast("bigint")
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return r["n"], r["b"] or 0


def _shape(users: tuple[int, int], items: tuple[int, int]) -> tuple[int, int]:
    """Blocks of users and chunks of items: few enough rows and bytes in each for a cell, and at least ``_CELLS`` cells. A user
    is sent to every chunk and an item to every block, so the side with more bytes is cut less."""
    least = [max(1, math.ceil(n / CELL_ROWS), math.ceil(b / CELL_BYTES)) for n, b in (users, items)]
    blocks, chunks = least
    while blocks * chunks < _CELLS:
        if items[1] * (blocks + 1) + users[1] * chunks <= items[1] * blocks + users[1] * (chunks + 1):
            blocks += 1
        else:
            chunks += 1
    return blocks, chunks


def _cell_keys(spark, n: int) -> list[int]:
    """n numbers that Spark's hash partitioning deals into n different partitions."""
    span = 16 * n
    while True:
        rows = (spark.range(span).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id")).collect())
        if len(rows) == n:
            return sorted(r["id"] for r in rows)
        span *= 2


def meet(pairs: DataFrame, items: DataFrame, users: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Pairs left-joined to the rows of their items and of their users (and to ``history``, by both).

    Pairs are many and the rows of both sides wide, so pairs travel once, and narrow: users are cut into blocks and items into
    chunks, a pair goes to the cell of its block and chunk, an item's row to every block and a user's to every chunk. The joins
    run inside the cells, whose size follows from counts; they hash the users and items, so that pairs meet them as a stream."""
    spark = pairs.sparkSession
    # Both sides of these joins are dealt by cell, a part of the join's keys.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    blocks, chunks = _shape(_side(users), _side(items))
    n = max(blocks * chunks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = F.array(*[F.lit(k).cast("bigint") for k in _cell_keys(spark, n)[:blocks * chunks]])

    def number(c: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(parts)).cast("int")

    def dealt(df: DataFrame, block: Column, chunk: Column) -> DataFrame:
        d = df.withColumn("_b", block).withColumn("_c", chunk)
        return d.withColumn("_cell", F.get(keys, F.col("_b") * chunks + F.col("_c"))).drop("_b", "_c").repartition(n, "_cell")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    block, chunk = number("user_id", blocks), number("recipe_id", chunks)
    j = dealt(pairs, block, chunk)
    if history is not None:
        j = j.join(dealt(history, block, chunk), ["_cell", "user_id", "recipe_id"], "left")
    j = j.join(dealt(items, every(blocks), chunk).hint("shuffle_hash"), ["_cell", "recipe_id"], "left")
    return j.join(dealt(users, block, every(chunks)).hint("shuffle_hash"), ["_cell", "user_id"], "left").drop("_cell")


def ingredient_similarity(pairs: DataFrame, interactions: DataFrame, bridge: DataFrame) -> DataFrame:
    """Jaccard / overlap / has-common between a pair's item ingredients and everything the
    user touched positively (X07, F29). One row per pair is joined, never one row per (pair, ingredient)."""
    us, rs = ingredient_sets(interactions, bridge)
    j = overlap_columns(meet(pairs, store(rs), store(us)))
    return j.select("user_id", "recipe_id", *[c for c in j.columns if c not in ("user_id", "recipe_id")])


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def impute_stats(df: DataFrame, skip_numeric=("label", "rating", "recipe_id"),
                 skip_text=("user_id", "recipe_id")) -> dict:
    """Exact medians of numeric columns (0 when all NULL) and modes of text columns
    (smallest on ties, 'unknown' when all NULL) of the columns that contain NULLs (A24)."""
    nulls = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in df.columns]).first().asDict()
    stats: dict = {}
    numeric = [f.name for f in df.schema.fields if nulls[f.name] > 0 and isinstance(f.dataType, _NUMERIC)
               and f.name not in skip_numeric]
    for c, med in exact_medians(df, numeric).items():
        stats[c] = 0.0 if med is None else med
    for f in df.schema.fields:
        if nulls[f.name] > 0 and isinstance(f.dataType, T.StringType) and f.name not in skip_text:
            counts = df.filter(F.col(f.name).isNotNull()).groupBy(f.name).agg(F.count(F.lit(1)).alias("_n"))
            top = counts.agg(F.min_by(f.name, F.struct(-F.col("_n"), F.col(f.name))).alias("m")).first()["m"]
            stats[f.name] = "unknown" if top is None else top
    return stats


def impute(df: DataFrame, stats: dict | None = None) -> DataFrame:
    """Fill NULLs with column medians / modes (I01, I02). ``stats`` from ``impute_stats``
    may come from another table (e.g. the train split, D5)."""
    stats = impute_stats(df) if stats is None else stats
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in stats and isinstance(f.dataType, _NUMERIC):
            # like pandas, an integer column with gaps is filled as floating point
            c = F.coalesce(c.cast("double"), F.lit(float(stats[f.name])))
        elif f.name in stats:
            c = F.coalesce(c, F.lit(stats[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def item_impute_stats(pairs: DataFrame, items: DataFrame, skip=("recipe_id",)) -> dict:
    """``impute_stats`` of the item columns of ``pairs`` joined to ``items``, without that join: an item's
    values count as often as it has pairs (exact medians and modes of a small weighted table)."""
    w = pairs.groupBy("recipe_id").agg(F.count(F.lit(1)).alias("_n")).join(items, "recipe_id").persist()
    try:
        fields = [f for f in items.schema.fields if f.name not in skip and isinstance(f.dataType, (*_NUMERIC, T.StringType))]
        nulls = w.agg(*[F.count(F.when(F.col(f.name).isNull(), 1)).alias(f.name) for f in fields]).first().asDict()
        numeric = [f.name for f in fields if nulls[f.name] and isinstance(f.dataType, _NUMERIC)]
        stats: dict = {}
        if numeric:
            cells = F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in numeric]))
            hist = (w.select("_n", cells.alias("_p")).filter(F.col("_p._v").isNotNull())
                    .groupBy("_p._c", "_p._v").agg(F.sum("_n").alias("_n")))
            stats = {c: 0.0 if m is None else m for c, m in histogram_medians(hist, numeric).items()}
        for f in fields:
            if nulls[f.name] and isinstance(f.dataType, T.StringType):
                counts = w.filter(F.col(f.name).isNotNull()).groupBy(f.name).agg(F.sum("_n").alias("_k"))
                top = counts.agg(F.min_by(f.name, F.struct(-F.col("_k"), F.col(f.name))).alias("m")).first()["m"]
                stats[f.name] = "unknown" if top is None else top
        return stats
    finally:
        w.unpersist()


def training_features(pairs: DataFrame, profiles: DataFrame, catalog_feats: DataFrame, bridge: DataFrame,
                      interactions: DataFrame, as_of: str | None = None, do_impute: bool = True, encoded: DataFrame | None = None) -> DataFrame:
    """The training feature table (I03): J01, J02, J04, F22/F23, F24, F25, X07, I01/I02.

    Everything a user or an item contributes is joined on its own side first and written; the pairs then meet both sides and
    their own history in one exchange of narrow rows (``meet``). ``encoded`` may hold further columns of the items (J12): they
    travel with the items and come last, as they are."""
    us, rs = ingredient_sets(interactions, bridge)
    items = add_bridge_count(catalog_feats, bridge)
    counts = author_counts(interactions, catalog_feats)
    by_author = counts.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("author_name", "user_author_interaction_count"))).alias("_by_author"))
    users = store(profiles.join(us, "user_id", "left").join(by_author, "user_id", "full"))
    wide = items.join(rs, "recipe_id", "left")
    more = [] if encoded is None else [c for c in encoded.columns if c != "recipe_id"]
    wide = store(wide if encoded is None else add_text_features(wide, encoded))
    t = history_columns(meet(pairs, wide, users, reengagement_stats(interactions)), as_of)
    own = {c for part in (pairs, users, wide) for c in part.columns}
    history = [c for c in t.columns if c not in own]
    t = overlap_columns(match_features(t))
    t = author_columns(t.withColumn("user_author_interaction_count", F.try_element_at("_by_author", F.col("author_name"))).drop("_by_author"))
    keys = ["user_id", "recipe_id", "author_name"]
    first = [*keys, *[c for part in (pairs, profiles, items) for c in part.columns if c not in keys]]
    t = t.select(*first, *[c for c in t.columns if c not in [*first, *history, *more]], *history, *more)
    if not do_impute:
        return t
    # Ids first: an anti join of the pairs themselves would exchange all of them.
    known = all(pairs.select(k).distinct().join(side, k, "left_anti").isEmpty() for k, side in (("user_id", profiles), ("recipe_id", items)))
    if known:
        # Only item columns can hold gaps, and the pairs per item say how often.
        t = impute(t, item_impute_stats(pairs, items))
    else:
        # Gaps anywhere: the statistics are taken from the table itself, written once.
        t = store(t)
        t = impute(t, impute_stats(t.drop(*more)))
    # Columns that may hold gaps are floating point whether or not this data has any.
    return t.withColumns({c: F.col(c).cast("double") for c in ("total_time", "servings", "ingredient_count_db")})
