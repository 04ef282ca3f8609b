"""Mixing sources to target weights: subset-sum budget fitting over exact token lengths.

Sources (ordered by code point, null last) weigh 1, 2, 3, repeating. Their targets share the
words of all documents by weight; a target stops at ``MAX_REPEATS`` times its source's size and
the excess is reshared by weight among the others until none is above.

A source takes all its documents floor(target / size) times; the remaining budget is filled by a
subset. Its documents are counted by exact length. A proportional share of every length is
taken, the rest of the budget is filled from long to short down to ``WINDOW`` words, and a
bounded-knapsack dynamic program over the lengths that are left (a bitset of reachable sums)
meets what remains exactly, or as nearly from below as the lengths allow. The plan says
how many documents of each length go in once more; which ones is decided by a seeded
hash of the row, numbered within (source, length) over range partitions, so a length
or a source that holds a third of all rows is spread over many tasks.

Defined results: null text has size 0; null source is a source of its own; rows without
words take part with size 0; repeated rows are separate documents; extra columns are
carried by ``mixed``; an empty table gives an empty result. Reruns agree: every choice depends on
the rows' content and ``seed`` alone.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import attach_once, columns, cut, fresh
from plateau.operators.stats import dense_index, group_row_number

MAX_REPEATS = 3
WINDOW = 16_384
WEIGHTS = (1, 2, 3)


def fit_subset(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that their words sum to ``budget`` or as
    little below it as a bounded knapsack over the last ``WINDOW`` words finds."""
    counts = {s: n for s, n in counts.items() if s > 0}
    total = sum(s * n for s, n in counts.items())
    if budget <= 0 or not total:
        return {}
    if budget >= total:
        return counts
    take = {s: n * budget // total for s, n in counts.items()}
    left = budget - sum(s * k for s, k in take.items())
    order = sorted(counts, reverse=True)
    for s in order:
        if left <= WINDOW:
            break
        k = min(counts[s] - take[s], max(0, left - WINDOW // 2) // s)
        take[s] += k
        left -= k * s
    free = [(s, counts[s] - take[s]) for s in order if s <= left and counts[s] > take[s]]
    if not free:
        return take
    best = left - left % math.gcd(*(s for s, _ in free))
    mask, reach = (1 << (left + 1)) - 1, [1]
    for s, n in free:
        r, k, step = reach[-1], min(n, left // s), 1
        while k > 0:
            step = min(step, k)
            r |= (r << (s * step)) & mask
            k -= step
            step *= 2
        reach.append(r)
        if r >> best & 1:
            break
    t = reach[-1].bit_length() - 1
    for i in range(len(reach) - 1, 0, -1):
        s = free[i - 1][0]
        while not reach[i - 1] >> t & 1:
            take[s] += 1
            t -= s
    return take


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> plus src (dense index), target. Each pass caps the sources above
    ``MAX_REPEATS`` and reshapes the share per weight; it ends when no further source is capped."""
    named = sizes.filter(F.col("source").isNotNull())
    ranked = dense_index(named, "source", "src").select("source", "source_size", F.col("src").cast("bigint").alias("src"))
    null = sizes.filter(F.col("source").isNull()).withColumn("src", F.lit(named.count()).cast("bigint"))
    t = cut(ranked.unionByName(null).withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)),
                                                                   (F.col("src") % len(WEIGHTS) + 1).cast("int"))))
    capped, share = -1, 0.0
    while True:
        above = F.lit(share) * F.col("w") > MAX_REPEATS * F.col("source_size") if capped >= 0 else F.lit(False)
        row = t.agg(F.sum("source_size").alias("all"), F.sum(above.cast("long")).alias("n"),
                    F.sum(F.when(above, MAX_REPEATS * F.col("source_size")).otherwise(0)).alias("held"),
                    F.sum(F.when(above, 0).otherwise(F.col("w"))).alias("w")).first()
        if row["all"] is None or (row["n"] or 0) == capped:
            break
        capped, share = row["n"], (row["all"] - row["held"]) / row["w"] if row["w"] else 0.0
    return t.withColumn("target", F.least(F.lit(share) * F.col("w"), (MAX_REPEATS * F.col("source_size")).cast("double")))


def _size(text_col: str):
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             seed: int = 0) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken, text_hash."""
    rows = cut(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(source_col).cast("string").alias("source"),
                           _size(text_col).alias("size"),
                           F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_hash"))
               .withColumn("pick", F.xxhash64(F.lit(seed), "id")))
    targets = cut(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))))
    hist = (rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
            .join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select("src", "source_size", "target", "size", "n"))

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        base = int(target // total) if total else 0
        take = fit_subset(dict(zip(pdf["size"].tolist(), pdf["n"].tolist())), round(target - base * total))
        return pd.DataFrame({"src": pdf["src"], "size": pdf["size"], "base": base,
                             "more": [take.get(s, 0) for s in pdf["size"].tolist()]})

    plans = cut(hist.groupBy("src").applyInPandas(plan, "src bigint, size bigint, base bigint, more bigint"))
    t = targets.select(F.col("source").alias("_s"), "src", "source_size", "target")
    coded = rows.join(t, rows["source"].eqNullSafe(t["_s"])).drop("_s")
    numbered = group_row_number(coded, ["src", "size"], ["pick", "id", "text_hash"], "rn")
    copies = F.col("base") + (F.col("rn") <= F.col("more")).cast("bigint")
    return (numbered.join(plans, ["src", "size"])
            .select("id", "source", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken"), "text_hash"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: int = 0) -> DataFrame:
    """The mix itself: every document with all its columns, as often as the plan takes it."""
    facts = cut(mix_plan(docs, id_col, text_col, source_col, seed)
                .groupBy(F.col("id").alias("_fid"), F.col("text_hash").alias("_fh"), F.col("source").alias("_fs"))
                .agg(F.count(F.lit(1)).alias("m"), F.sum("copies").alias("_copies")).filter("_copies > 0"))
    out, copies = attach_once(docs, facts, {"_fid": F.col(id_col).cast("bigint"),
                                            "_fh": F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))),
                                            "_fs": F.col(source_col).cast("string")}, "_copies")
    copy = fresh(out, "_copy")
    again = out.select("*", F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(copy))
    return again.select(*columns(docs))
