"""Exact order statistics and dense indexes without a single-partition window.

``exact_quantile`` finds the values at the needed ranks by narrowing a value range:
values are first reduced to (value, count) pairs (map-side partial aggregation, so a
value held by a third of all rows is one pair), then, while the range still holds more
than ``buckets`` distinct values, it is cut into ~``buckets`` parts at approximate
quantiles and only the part holding the rank is kept. No step returns more than
``buckets`` rows to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


BUCKETS = 256


def _value_at_ranks(hist: DataFrame, ranks: list[int], buckets: int = BUCKETS) -> dict[int, float]:
    out: dict[int, float] = {}
    # Each pending search: (rank, lower bound exclusive, upper bound inclusive, rows below range)
    pending = [(r, None, None, 0) for r in ranks]
    while pending:
        r, lo, hi, below = pending.pop()
        sub = hist
        if lo is not None:
            sub = sub.filter(F.col("v") > F.lit(lo))
        if hi is not None:
            sub = sub.filter(F.col("v") <= F.lit(hi))
        n_distinct = sub.count()
        if n_distinct <= buckets:
            acc = below
            for row in sub.orderBy("v").collect():
                acc += row["n"]
                if acc > r:
                    out[r] = row["v"]
                    break
            continue
        qs = [i / buckets for i in range(1, buckets)]
        cuts = sub.agg(F.percentile_approx("v", qs, 10 * buckets).alias("c")).first()["c"]
        cuts = sorted(set(cuts))
        b = F.lit(len(cuts))
        for i in reversed(range(len(cuts))):
            b = F.when(F.col("v") <= F.lit(cuts[i]), F.lit(i)).otherwise(b)
        counts = {row["b"]: row["n"] for row in sub.groupBy(b.alias("b")).agg(F.sum("n").alias("n")).collect()}
        acc = below
        for i in range(len(cuts) + 1):
            c = counts.get(i, 0)
            if acc + c > r:
                new_lo = lo if i == 0 else cuts[i - 1]
                new_hi = hi if i == len(cuts) else cuts[i]
                pending.append((r, new_lo, new_hi, acc))
                break
            acc += c
    return out


def exact_quantiles(df: DataFrame, col: str, qs: list[float], buckets: int = BUCKETS) -> list[float | None]:
    """Linear-interpolated quantiles (pandas/DuckDB ``quantile_cont``) of a numeric column."""
    hist = (df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
            .groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    hist = hist.persist()
    try:
        n = hist.agg(F.sum("n")).first()[0] or 0
        if n == 0:
            return [None for _ in qs]
        pos = [(n - 1) * q for q in qs]
        ranks = sorted({int(math.floor(p)) for p in pos} | {int(math.ceil(p)) for p in pos})
        vals = _value_at_ranks(hist, ranks, buckets)
        res = []
        for p in pos:
            a, b = vals[int(math.floor(p))], vals[int(math.ceil(p))]
            res.append(a + (b - a) * (p - math.floor(p)))
        return res
    finally:
        hist.unpersist()


def exact_median(df: DataFrame, col: str) -> float | None:
    return exact_quantiles(df, col, [0.5])[0]


def dense_index(df: DataFrame, order_col: str, index_col: str = "idx") -> DataFrame:
    """0-based dense index of the rows of ``df`` ordered by ``order_col`` (unique).

    Range-partitions by the key, counts rows per partition (one small row per partition
    to the driver) and adds each partition's offset to a per-partition row number, so no
    window runs over the whole table in one task.
    """
    ranged = df.repartitionByRange(order_col).withColumn("_pid", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)  # partition ids written with the rows
    sizes = sorted((r["_pid"], r["n"]) for r in ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, acc = [], 0
    for pid, n in sizes:
        offsets.append((pid, acc))
        acc += n
    spark = df.sparkSession
    off = spark.createDataFrame(offsets, "_pid int, _off long")
    w = Window.partitionBy("_pid").orderBy(order_col)
    return (ranged.join(F.broadcast(off), "_pid")
            .withColumn(index_col, F.row_number().over(w) - 1 + F.col("_off"))
            .drop("_pid", "_off"))


def group_row_number(df: DataFrame, group: list[str], order: list[str], out: str = "position") -> DataFrame:
    """1-based row number within each group, safe for groups of any size.

    A plain ``Window.partitionBy(group)`` sorts a whole group in one task. Here rows are
    range-partitioned on (group, order) so one large group spans many tasks; each task
    numbers its slice, and per-(partition, group) counts give the offsets (a window over
    at most #partitions rows per group).
    """
    keys = [*group, *order]
    # Partition ids are written with the rows (reliable checkpoint in the shared folder), so
    # both uses below see the same ids whatever happens to caches or executors.
    ranged = df.repartitionByRange(*keys).withColumn("_pid", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group).orderBy("_pid")
    offs = counts.withColumn("_off", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    w2 = Window.partitionBy("_pid", *group).orderBy(*order)
    return (ranged.join(offs, ["_pid", *group])
            .withColumn(out, (F.row_number().over(w2) + F.col("_off")).cast("bigint"))
            .drop("_pid", "_off"))


def average_ranks(df: DataFrame, col: str, out: str, weight: str | None = None) -> DataFrame:
    """1-based average rank of ``col`` over the whole table (ties share the mean rank); with ``weight`` a
    row stands for that many rows.

    Values are reduced to (value, count); those pairs are range-partitioned, each task
    computes its local running count, and per-partition totals (one row per partition
    on the driver) give the offsets. The ranks are joined back on the value.
    """
    hist = df.groupBy(F.col(col).alias("_v")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_c"))
    ranged = hist.repartitionByRange("_v").withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    sizes = sorted((r["_pid"], r["n"]) for r in ranged.groupBy("_pid").agg(F.sum("_c").alias("n")).collect())
    offsets, acc = [], 0
    for pid, n in sizes:
        offsets.append((pid, acc))
        acc += n
    off = df.sparkSession.createDataFrame(offsets, "_pid int, _off long")
    w = Window.partitionBy("_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = (ranged.join(F.broadcast(off), "_pid")
             .withColumn("_below", F.sum("_c").over(w) - F.col("_c") + F.col("_off"))
             .select("_v", (F.col("_below") + (F.col("_c") + 1) / 2.0).alias(out)))
    return df.join(ranks, df[col].eqNullSafe(ranks["_v"]), "left").drop("_v")


def modal_value(df: DataFrame, key: str | list[str], col: str, out: str) -> DataFrame:
    """Most frequent non-NULL ``col`` per key, smallest value on ties.

    Two codegen'd hash aggregates (count per (key, value), then ``min_by`` over
    (-count, value)) instead of the object-buffer ``mode`` aggregate; both levels combine
    partially on the map side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    c = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    return c.groupBy(*keys).agg(F.min_by(col, F.struct(-F.col("_n"), F.col(col))).alias(out))


def modal_values(df: DataFrame, key: str, cols: dict[str, str]) -> DataFrame:
    """Several ``modal_value`` columns from one pass: the (column, value) pairs of each row
    are stacked, counted per (key, column, value), reduced with ``min_by`` and pivoted
    back over the known column list."""
    names = list(cols)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("string").alias("_v")) for c in names]))
    s = df.select(key, pairs.alias("_p")).select(key, "_p._c", "_p._v").filter(F.col("_v").isNotNull())
    c = s.groupBy(key, "_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    top = c.groupBy(key, "_c").agg(F.min_by("_v", F.struct(-F.col("_n"), F.col("_v"))).alias("_m"))
    wide = top.groupBy(key).pivot("_c", names).agg(F.first("_m"))
    return wide.select(key, *[F.col(c).alias(cols[c]) for c in names])


def exact_medians(df: DataFrame, cols: list[str], buckets: int = BUCKETS) -> dict[str, float | None]:
    """Exact medians of several numeric columns from one stacked (column, value) histogram, each by the
    narrowing search."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in cols])) if cols else None
    return histogram_medians(df.select(pairs.alias("_p")).select("_p._c", "_p._v").filter(F.col("_v").isNotNull())
                             .groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n")), cols, buckets) if cols else {}


def histogram_medians(hist: DataFrame, cols: list[str], buckets: int = BUCKETS) -> dict[str, float | None]:
    """Exact medians from a histogram (_c column name, _v value, _n rows)."""
    hist = hist.persist()
    try:
        total = {r["_c"]: r["n"] for r in hist.groupBy("_c").agg(F.sum("_n").alias("n")).collect()}
        out: dict[str, float | None] = {}
        for c in cols:
            n = total.get(c, 0)
            ranks = sorted({(n - 1) // 2, n // 2})
            one = hist.filter(F.col("_c") == c).select(F.col("_v").alias("v"), F.col("_n").alias("n"))
            out[c] = sum(_value_at_ranks(one, ranks, buckets).values()) / len(ranks) if n else None
        return out
    finally:
        hist.unpersist()
