"""Exploratory aggregates.

All are grouped aggregates with map-side partial aggregation; global shares use a
1-row total joined back (broadcast of a single row), never a window without
partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_events(df: DataFrame, names: list[str], col: str = "event_type") -> DataFrame:
    """Event-name IN-list filter (P05); pushed into the scan when the column is stored."""
    return df.filter(F.col(col).isin(list(names)))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, count)`` per distinct value of ``col``."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))


from pyspark.sql import Window  # noqa: E402

from plateau.config import (ACTIVE_USER_MIN_EVENTS, EDA_RECIPE_EVENTS, ENGAGEMENT_BUCKETS,  # noqa: E402
                            FUNNEL_STEPS, INGREDIENT_EVENTS, RECIPE_EVENTS, USER_SEGMENT_TOP, USER_SEGMENTS)
from plateau.functions.calendar import whole_days_between  # noqa: E402
from plateau.operators.stats import exact_median, group_row_number, modal_values  # noqa: E402

USER = "distinct_id"


def with_calendar(events: DataFrame) -> DataFrame:
    """Epoch seconds -> datetime, date, hour, month, year."""
    dt = F.timestamp_seconds(F.col("timestamp"))
    return events.withColumns({"datetime": dt, "date": F.to_date(dt), "hour": F.hour(dt).cast("bigint"),
                               "month": F.month(dt).cast("bigint"), "year": F.year(dt).cast("bigint")})


def basic_stats(events: DataFrame) -> DataFrame:
    """Rows, distinct users and devices, first/last date and span in days (A10)."""
    ev = with_calendar(events)
    return ev.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct(USER).alias("unique_users"),
        F.countDistinct("device_id").alias("unique_devices"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    ).withColumn("span_days", F.datediff("last_date", "first_date").cast("bigint"))


def per_user_counts(events: DataFrame, user: str = USER) -> DataFrame:
    return events.groupBy(user).agg(F.count(F.lit(1)).alias("n_events"))


def count_distribution(counts: DataFrame, col: str = "n_events") -> DataFrame:
    """Mean, exact median, min and max of a per-user count column."""
    med = exact_median(counts, col)
    return counts.agg(F.avg(col).alias("mean"), F.min(col).cast("bigint").alias("min"),
                      F.max(col).cast("bigint").alias("max"),
                      F.count(F.lit(1)).alias("n_users")).withColumn("median", F.lit(med).cast("double"))


def ingredient_distribution(events: DataFrame) -> DataFrame:
    """Count and % share of the ingredient events."""
    return event_distribution(events, INGREDIENT_EVENTS)


def events_per_user_stats(events: DataFrame) -> DataFrame:
    return count_distribution(per_user_counts(events))


def event_distribution(events: DataFrame, names: list[str] | None = None, col: str = "event") -> DataFrame:
    """Count and % share per event name within the (optionally filtered) events."""
    ev = events if names is None else events.filter(F.col(col).isin(list(names)))
    counts = ev.groupBy(F.col(col).alias("event")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))  # one row, from the groups: one scan
    return (counts.crossJoin(F.broadcast(total))
            .withColumn("percentage", F.col("count") / F.col("_total") * 100).drop("_total"))


def engagement_buckets(recipe_events: DataFrame) -> DataFrame:
    """Users with 1, 2-5, 6-10 and more than 10 recipe interactions."""
    counts = per_user_counts(recipe_events)
    aggs = []
    for lo, hi, name in ENGAGEMENT_BUCKETS:
        cond = F.col("n_events") >= lo
        if hi is not None:
            cond = cond & (F.col("n_events") <= hi)
        aggs.append(F.count(F.when(cond, 1)).alias(f"users_{name}"))
    return counts.agg(*aggs)


def daily_activity(events: DataFrame) -> DataFrame:
    """Mean events per day, peak and quietest day (earliest date on ties)."""
    daily = with_calendar(events).groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return daily.agg(
        F.avg("n").alias("mean_per_day"),
        F.max("n").alias("peak_count"),
        F.min_by("date", F.struct(-F.col("n"), F.col("date"))).alias("peak_day"),
        F.min("n").alias("quietest_count"),
        F.min_by("date", F.struct(F.col("n"), F.col("date"))).alias("quietest_day"),
    )


def hourly_top(events: DataFrame, k: int = 3) -> DataFrame:
    """The k busiest hours (lower hour first on ties) (W06); the limit is the report."""
    hourly = with_calendar(events).groupBy("hour").agg(F.count(F.lit(1)).alias("count"))
    return hourly.orderBy(F.col("count").desc(), F.col("hour")).limit(k)


def weekday_activity(events: DataFrame) -> DataFrame:
    """Events and % share per weekday name."""
    counts = events.groupBy("day_of_week").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))  # one row, from the groups: one scan
    return (counts.crossJoin(F.broadcast(total))
            .withColumn("percentage", F.col("count") / F.col("_total") * 100).drop("_total"))


def weekend_split(events: DataFrame) -> DataFrame:
    """Weekend and weekday event counts and shares; unknown days count in neither."""
    return events.agg(
        F.count(F.when(F.col("is_weekend"), 1)).alias("weekend_events"),
        F.count(F.when(~F.col("is_weekend"), 1)).alias("weekday_events"),
        F.count(F.lit(1)).alias("total_events"),
    ).withColumns({
        "weekend_pct": F.col("weekend_events") / F.col("total_events") * 100,
        "weekday_pct": F.col("weekday_events") / F.col("total_events") * 100,
    })


def segment_of(n) -> "F.Column":
    expr = F.lit(USER_SEGMENT_TOP)
    for bound, name in reversed(USER_SEGMENTS):
        expr = F.when(n <= bound, F.lit(name)).otherwise(expr)
    return expr


def user_segments(events: DataFrame) -> DataFrame:
    """Users, % of users and mean events per activity segment."""
    counts = per_user_counts(events).withColumn("segment", segment_of(F.col("n_events")))
    seg = counts.groupBy("segment").agg(F.count(F.lit(1)).alias("users"), F.avg("n_events").alias("avg_events"))
    n_users = seg.agg(F.sum("users").alias("_total"))  # one row, from the groups: one scan
    return (seg.crossJoin(F.broadcast(n_users))
            .withColumn("percentage", F.col("users") / F.col("_total") * 100).drop("_total"))


def user_activity_summary(events: DataFrame) -> DataFrame:
    """Per user: events, first/last seen, modal weekday / time of day / device / platform
    (smallest on ties, 'Unknown' when none), days active and events per day (A08)."""
    ev = with_calendar(events)
    s = ev.groupBy(USER).agg(
        F.count("event").alias("total_events"),
        F.min("datetime").alias("first_seen"), F.max("datetime").alias("last_seen"),
    )
    modes = modal_values(ev, USER, {"day_of_week": "preferred_day", "time_of_day": "preferred_time",
                                    "device_type": "device_type", "platform": "platform"})
    s = s.join(modes, USER, "left")
    for out in ("preferred_day", "preferred_time", "device_type", "platform"):
        s = s.withColumn(out, F.coalesce(out, F.lit("Unknown")))
    return (s.withColumn("days_active", whole_days_between("first_seen", "last_seen") + 1)
            .withColumn("events_per_day", F.col("total_events") / F.col("days_active")))


def funnel(recipe_events: DataFrame, steps: list[str] | None = None) -> DataFrame:
    """Distinct users per funnel step and % of users with any recipe event (A16). The events are read once: a user
    is one row that says which steps it took."""
    steps = list(steps or FUNNEL_STEPS)
    took = recipe_events.groupBy(USER).agg(*[F.max(F.col("event") == s).alias(f"_{i}") for i, s in enumerate(steps)])
    total = took.agg(F.count(USER).alias("_total"), *[F.count(F.when(F.col(f"_{i}"), 1)).alias(f"_{i}") for i in range(len(steps))])
    rows = F.array(*[F.struct(F.lit(s).alias("event"), F.lit(i).alias("step"), F.col(f"_{i}").alias("users")) for i, s in enumerate(steps)])
    return (total.select("_total", F.explode(rows).alias("_r")).select("_r.*", "_total")
            .withColumn("percentage", F.col("users") / F.col("_total") * 100).drop("_total"))


# The groupings of the one-scan report.
_SETS = ("event", "day_of_week", "is_weekend", "date", "hour", "device_id", USER)


def activity_sets(events: DataFrame) -> DataFrame:
    """Counts of events and recipe events for every grouping the report needs, from one scan: GROUPING SETS over one calendar
    projection. Each row is expanded once per set and reduced in its map task before the shuffle; ``gid`` names the set."""
    ev = with_calendar(events).select(*_SETS, F.col("event").isin(EDA_RECIPE_EVENTS).alias("_recipe"))
    sets = [[], *[[c] for c in _SETS], ["event", USER]]
    cols = [F.col(c) for c in _SETS]
    return (ev.groupingSets([[F.col(c) for c in s] for s in sets], *cols)
            .agg(F.grouping_id(*cols).alias("gid"), F.count(F.lit(1)).alias("n"), F.sum(F.col("_recipe").cast("bigint")).alias("recipe")))


def _gid(*cols: str) -> int:
    """The grouping id of a set: a bit is 1 for every column that is summed over."""
    return sum(1 << i for i, c in enumerate(reversed(_SETS)) if c not in cols)


def report(sets: DataFrame) -> DataFrame:
    """(report, key, n, users) from the rows of ``activity_sets``: one more aggregate over groups, not events."""
    name = F.when(F.col("gid") == _gid(), "total")
    for c, out in (("event", "event"), ("day_of_week", "weekday"), ("is_weekend", "weekend"), ("date", "date"), ("hour", "hour"),
                   ("device_id", "devices"), (USER, "users")):
        name = name.when(F.col("gid") == _gid(c), out)
    name = name.when(F.col("gid") == _gid("event", USER), "pair")
    bucket = None
    for lo, hi, label in ENGAGEMENT_BUCKETS:
        inside = (F.col("recipe") >= lo) if hi is None else F.col("recipe").between(lo, hi)
        bucket = F.when(inside, label) if bucket is None else bucket.when(inside, label)
    text = lambda c: F.col(c).cast("string")
    one = F.lit(1).cast("bigint")
    none, no_key = F.lit(None).cast("bigint"), F.lit(None).cast("string")

    def entry(when, what, key, n, users):
        return F.when(when, F.struct(F.lit(what).alias("report"), key.alias("key"), n.alias("n"), users.alias("users")))
    is_ = lambda x: F.col("_set") == x
    known = F.col(USER).isNotNull()
    seen = F.when(known, one).otherwise(0)
    rows = F.array(
        entry(is_("total"), "total", no_key, F.col("n"), none),
        entry(is_("event"), "event", text("event"), F.col("n"), F.lit(0).cast("bigint")),
        entry(is_("pair"), "event", text("event"), F.lit(0).cast("bigint"), seen),
        entry(is_("event") & (F.col("recipe") > 0), "recipe_event", text("event"), F.col("recipe"), F.lit(0).cast("bigint")),
        entry(is_("pair") & (F.col("recipe") > 0), "recipe_event", text("event"), F.lit(0).cast("bigint"), seen),
        entry(is_("weekday"), "weekday", text("day_of_week"), F.col("n"), none),
        entry(is_("weekend"), "weekend", text("is_weekend"), F.col("n"), none),
        entry(is_("date"), "date", text("date"), F.col("n"), none),
        entry(is_("hour"), "hour", text("hour"), F.col("n"), none),
        entry(is_("users"), "segment", segment_of(F.col("n")), F.col("n"), one),
        entry(is_("users") & (F.col("recipe") > 0), "bucket", bucket, F.col("recipe"), one),
        entry(is_("users"), "users", no_key, none, seen),
        entry(is_("devices"), "devices", no_key, none, F.when(F.col("device_id").isNotNull(), one).otherwise(0)))
    flat = sets.withColumn("_set", name).select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x")).select("x.*")
    return flat.groupBy("report", "key").agg(F.sum("n").alias("n"), F.sum("users").alias("users"))


def insights(events: DataFrame, recipe_events: DataFrame, summary: DataFrame) -> DataFrame:
    """One-row insights report (A15): engagement share, cold-start users, sparsity
    (users x event types, as the reference; plus users x items), interactions per engaged
    user, active users (>= 5 events) with and without recipe events."""
    tot = events.agg(F.countDistinct(USER).alias("total_users"))
    rec = recipe_events.agg(
        F.countDistinct(USER).alias("recipe_users"),
        F.count(F.lit(1)).alias("recipe_interactions"),
        F.countDistinct("event").alias("recipe_event_types"),
        F.countDistinct("recipe_id").alias("recipe_items"),
        F.countDistinct(USER, "recipe_id").alias("user_item_pairs"),
    )
    active = summary.filter(F.col("total_events") >= ACTIVE_USER_MIN_EVENTS).select(USER)
    act = active.agg(F.count(F.lit(1)).alias("active_users"))
    act_rec = (recipe_events.select(USER).distinct().join(active, USER, "left_semi")
               .agg(F.count(F.lit(1)).alias("active_with_recipes")))
    r = tot.crossJoin(rec).crossJoin(act).crossJoin(act_rec)  # four 1-row tables
    return r.withColumns({
        "recipe_engagement_pct": F.col("recipe_users") / F.col("total_users") * 100,
        "cold_start_users": F.col("total_users") - F.col("recipe_users"),
        "sparsity_pct": (1 - F.col("recipe_interactions") / (F.col("recipe_users") * F.col("recipe_event_types"))) * 100,
        "item_sparsity_pct": (1 - F.col("user_item_pairs") / (F.col("recipe_users") * F.col("recipe_items"))) * 100,
        "interactions_per_engaged_user": F.col("recipe_interactions") / F.col("recipe_users"),
        "popularity_fallback_users": F.col("total_users") - F.col("active_with_recipes"),
    })


def user_summary(events: DataFrame, recipe_events: list[str] | None = None) -> DataFrame:
    """Per-user activity summary (A18, batch form of the single-user lookup): total and
    recipe events, per-event counts map, first/last seen epoch seconds,
    ``days_active = max(1, (last - first) // 86400)``."""
    names = list(recipe_events or RECIPE_EVENTS)
    per_type = events.groupBy(USER, "event").agg(F.count(F.lit(1)).alias("n"))
    types = per_type.groupBy(USER).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("event", "n")))).alias("event_types"))
    base = events.groupBy(USER).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count(F.when(F.col("event").isin(names), 1)).alias("recipe_events"),
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"),
    ).withColumn("days_active", F.greatest(F.lit(1), F.floor((F.col("last_seen") - F.col("first_seen")) / 86400))
                 .cast("bigint"))
    return base.join(types, USER)


def interaction_range(interactions: DataFrame, user: str = "user_id") -> DataFrame:
    """'YYYY-MM-DD to YYYY-MM-DD' range of each user's interactions."""
    r = interactions.groupBy(user).agg(F.min("timestamp").alias("_a"), F.max("timestamp").alias("_b"),
                                       F.count(F.lit(1)).alias("n_interactions"))
    fmt = lambda c: F.date_format(F.timestamp_seconds(F.col(c)), "yyyy-MM-dd")
    return r.select(user, "n_interactions",
                    F.concat(fmt("_a"), F.lit(" to "), fmt("_b")).alias("time_range"))


def timeline(interactions: DataFrame, user: str = "user_id") -> DataFrame:
    """Per-user position of each interaction in time order, ties by ``seq``.

    Numbered with ``group_row_number`` so a user holding a large share of all rows is
    spread over many tasks."""
    return group_row_number(interactions, [user], ["timestamp", "seq"], "position")


def top_users(events: DataFrame, n: int = 10, user: str = USER) -> DataFrame:
    """The n most active users (smaller id first on ties) (W11); the limit is the report."""
    return (events.groupBy(user).agg(F.count(F.lit(1)).alias("events"))
            .orderBy(F.col("events").desc(), F.col(user)).limit(n))


def recipe_event_rows(events: DataFrame) -> DataFrame:
    """Events of the exploration report's recipe set."""
    return events.filter(F.col("event").isin(EDA_RECIPE_EVENTS))
