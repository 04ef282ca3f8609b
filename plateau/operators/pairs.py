"""(user, item) training pairs: positives with graded labels, seeded negatives,
eligibility (A02, A03, A04, N01, N02, P08, J10, U01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.config import INTERACTION_WEIGHTS
from plateau.functions.common import weight_of
from plateau.functions.hashing import md5_int
from plateau.operators.stats import dense_index
from plateau.session import store

PAIR_COLUMNS = ["user_id", "recipe_id", "rating", "label"]


def positive_pairs(interactions: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per touched (user, item).

    ``rating`` = max rating; ``event_type`` = the first event (by ``seq``) with the highest
    weight (unknown names weigh 1.0); ``datetime`` = latest; ``version`` = first by ``seq``;
    ``label`` = weight of that event, negative weights -> 0.1. All parts are one
    partial-aggregated ``groupBy``.
    """
    w = weights or INTERACTION_WEIGHTS
    ew = weight_of(F.col("event_type"), w, default=1.0)
    g = interactions.groupBy("user_id", "recipe_id").agg(
        F.max("rating").alias("rating"),
        F.min_by("event_type", F.struct(-ew, F.col("seq"), F.col("event_type"))).alias("event_type"),
        F.max("datetime").alias("datetime"),
        F.min_by("version", F.struct(F.col("seq"), F.col("version"))).alias("version"),
    )
    label = weight_of(F.col("event_type"), w, default=1.0)
    return g.withColumn("label", F.when(label < 0, F.lit(0.1)).otherwise(label))


def _next_prime(n: int) -> int:
    def is_prime(k: int) -> bool:
        if k < 2:
            return False
        i = 2
        while i * i <= k:
            if k % i == 0:
                return False
            i += 1
        return True
    k = max(n, 2)
    while not is_prime(k):
        k += 1
    return k


def negative_samples(pos: DataFrame, catalog: DataFrame, ratio: int = 4, seed: int = 42,
                     chunk: int = 4096) -> DataFrame:
    """Seeded negatives (N01, J10): per user ``min(ratio * n_pos, #untouched)`` distinct
    catalog items the user never touched, with rating 0 and label 0.

    Exact and bounded without a users x catalog product: catalog items get a dense index
    in md5(seed, item) order; each user walks its own permutation of the indexes
    ``pos -> (a_u * pos + b_u) mod P`` (P = smallest prime >= catalog size, a_u, b_u from
    md5(seed, user)). The permutation is inverted for what a user may not draw, the items it touched and
    the ``P - N`` indexes that name none, which gives their positions; the stretches between these, up to
    the ``m_u``-th free position, are the sample. A user is one row until then (its touched indexes as a list, at most the
    catalog), no candidate is drawn in vain, and only the sampled rows travel, once, to their item ids. Stretches are cut
    into chunks spread over tasks.
    """
    spark = pos.sparkSession
    items = catalog.select(F.col("recipe_id").cast("string").alias("recipe_id")).distinct()
    items = items.withColumn("_key", F.concat(F.lpad(F.conv(F.substring(
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("recipe_id"))), 1, 8), 16, 10), 10, "0"),
        F.lit("|"), F.col("recipe_id")))
    indexed = dense_index(items, "_key", "_idx").select("recipe_id", F.col("_idx").cast("bigint").alias("_idx"))
    n_items = indexed.count()
    if n_items == 0:
        return spark.createDataFrame([], "user_id string, recipe_id string, rating double, label double")
    p = _next_prime(n_items)
    touched = pos.select("user_id", "recipe_id").distinct().filter(F.col("user_id").isNotNull())
    big = lambda n: F.lit(n).cast("bigint")
    users = (touched.join(indexed, "recipe_id", "left").groupBy("user_id")
             .agg(F.count(F.lit(1)).alias("_npos"), F.collect_list("_idx").alias("_own"))
             .withColumn("_m", F.least(F.col("_npos") * ratio, big(n_items) - F.size("_own")))
             .filter(F.col("_m") > 0)
             .withColumn("_a", F.lit(1) + F.pmod(md5_int(F.lit(str(seed)), F.lit("a"), F.col("user_id")), big(p - 1)))
             .withColumn("_b", F.pmod(md5_int(F.lit(str(seed)), F.lit("b"), F.col("user_id")), big(p))))
    # a^(p-2) mod p undoes a: squared and multiplied along the bits of p - 2
    bits = F.array(*[F.lit(c == "1") for c in format(p - 2, "b")])
    inverse = F.aggregate(bits, big(1), lambda acc, bit: (acc * acc % p) * F.when(bit, F.col("_a")).otherwise(big(1)) % p)
    # no position behind this one is needed, whatever the order
    reach = F.col("_m") + F.size("_own") + big(p - n_items)
    users = (users.withColumn("_inv", inverse).withColumn("_end", reach)
             .withColumn("_own", F.concat("_own", F.sequence(big(n_items), big(p - 1))) if p > n_items else F.col("_own"))
             .withColumn("_own", F.array_sort(F.filter(F.transform("_own", lambda x: F.pmod(F.col("_inv") * F.pmod(x - F.col("_b"), big(p)), big(p))),
                                                       lambda j: j < F.col("_end")))))
    # the r-th taken position leaves (position - r) free ones before it; the last stretch ends with the m-th free one
    stretch = F.transform(F.concat("_own", F.array(big(p))), lambda j, r: F.struct(
        F.when(r == 0, big(0)).otherwise(F.try_element_at("_own", F.greatest(r, F.lit(1))) + 1).alias("lo"),
        F.least(j - 1, F.col("_m") + r - 1).alias("hi")))
    stretches = users.withColumn("_s", F.explode(F.filter(stretch, lambda s: s["lo"] <= s["hi"]))).select("user_id", "_a", "_b", "_s.*")
    chunks = (stretches.withColumn("lo", F.explode(F.sequence(F.col("lo"), F.col("hi"), big(chunk))))
              .withColumn("hi", F.least("hi", F.col("lo") + (chunk - 1))).repartition("user_id", "lo"))
    drawn = (chunks.withColumn("_j", F.explode(F.sequence("lo", "hi")))
             .select("user_id", F.pmod(F.col("_a") * F.col("_j") + F.col("_b"), big(p)).alias("_idx")))
    return drawn.join(indexed, "_idx").select("user_id", "recipe_id", F.lit(0.0).alias("rating"), F.lit(0.0).alias("label"))


def user_item_pairs(interactions: DataFrame, catalog: DataFrame, ratio: int = 4, seed: int = 42,
                    weights: dict[str, float] | None = None, rule: str | None = None) -> DataFrame:
    """Positives ∪ negatives (N02, U01) with ``user_id, recipe_id, rating, label, datetime``
    (``datetime`` = latest interaction for positives, NULL for negatives; D3). With ``rule`` the pairs are those
    ``eligible_pairs`` keeps: negatives are labelled 0 and drawn user by user, so the positives decide before any is drawn."""
    pos = positive_pairs(interactions, weights).select(*PAIR_COLUMNS, "datetime")
    if rule is not None:
        pos = eligible_pairs(pos, interactions, rule)
    pos = store(pos)
    neg = negative_samples(pos, catalog, ratio, seed)
    return pos.unionByName(neg.withColumn("datetime", F.lit(None).cast(pos.schema["datetime"].dataType)))


def class_counts(pairs: DataFrame) -> DataFrame:
    """Positive / negative counts and shares of a pair table (N02 report)."""
    c = pairs.groupBy((F.col("label") > 0).alias("positive")).agg(F.count(F.lit(1)).alias("pairs"))
    total = c.agg(F.sum("pairs").alias("_t"))  # from the groups' own counts: one scan
    return c.crossJoin(F.broadcast(total)).withColumn("percentage", F.col("pairs") / F.col("_t") * 100).drop("_t")


def eligible_pairs(pairs: DataFrame, interactions: DataFrame, rule: str = "eq1") -> DataFrame:
    """Keep pairs of users with interactions and at least one pair labelled exactly 1
    (``rule='eq1'``, the reference's test, D2) or any positive label (``'gt0'``) (P08, J11, U02)."""
    cond = (F.col("label") == 1.0) if rule == "eq1" else (F.col("label") > 0)
    with_pos = pairs.filter(cond).select("user_id").distinct()
    with_int = interactions.select("user_id").distinct()
    ok = with_pos.join(with_int, "user_id", "left_semi")
    return pairs.join(ok, "user_id", "left_semi")


def reengagement_stats(interactions: DataFrame) -> DataFrame:
    """Per (user, item): interaction count, max and mean rating, last time."""
    return interactions.groupBy("user_id", "recipe_id").agg(
        F.count(F.lit(1)).alias("user_recipe_interaction_count"),
        F.max("rating").alias("user_recipe_max_rating"),
        F.avg("rating").alias("user_recipe_avg_rating"),
        F.max("datetime").alias("user_recipe_last_interaction"),
    )
