"""Sinks that spare later work: buckets, single partitions, reports in the writing pass."""

import random
import uuid

from pyspark.sql import functions as F

from plateau.session import checkpoint_dir
from plateau.sources import io as IO


def place(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/sink-{uuid.uuid4().hex}"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_exchange(spark):
    rng = random.Random(1)
    pairs = spark.createDataFrame([(f"u{rng.randrange(40)}", f"r{i}") for i in range(900)] + [("hot", f"r{i}") for i in range(400)],
                                  "user_id string, recipe_id string")
    users = pairs.groupBy("user_id").agg(F.count("recipe_id").alias("n"))
    a = IO.write_bucketed(pairs, f"a_{uuid.uuid4().hex}", place(spark), ["user_id"], 4, ["user_id", "recipe_id"])
    b = IO.write_bucketed(users, f"b_{uuid.uuid4().hex}", place(spark), ["user_id"], 4)
    joined = a.join(b.hint("merge"), "user_id")
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, pairs.join(users, "user_id").collect()))
    grouped = a.groupBy("user_id").count()
    assert "Exchange" not in plan_of(grouped) and grouped.filter("user_id = 'hot'").first()["count"] == 400


def test_only_the_given_partitions_are_replaced(spark):
    path = place(spark)
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "x int, split string")
    IO.overwrite_partitions(first, path, ["split"])
    IO.overwrite_partitions(spark.createDataFrame([(9, "b")], "x int, split string"), path, ["split"])
    assert sorted((r["x"], r["split"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_report_is_taken_while_writing(spark):
    """The rows' plan runs once: every row passes the counter one time."""
    passes = spark.sparkContext.accumulator(0)

    def seen(it):
        for b in it:
            passes.add(b.num_rows)
            yield b
    df = spark.range(500).selectExpr("id", "id % 3 AS k").mapInArrow(seen, "id long, k long")
    path = place(spark)
    got = IO.write_observed(df, path, {"rows": F.count(F.lit(1)), "zeros": F.count(F.when(F.col("k") == 0, 1)), "top": F.max("id")}, ["k"])
    assert got == {"rows": 500, "zeros": 167, "top": 499} and passes.value == 500
    assert spark.read.parquet(path).count() == 500
