"""Scalable algorithms against brute force: exact quantiles, group row numbers, average
ranks, NDCG (scikit-learn's tie-averaged definition, re-implemented here), recall."""

import math
import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from plateau.operators.evaluate import ndcg_per_user, rank_correlation, recall_per_user
from plateau.operators.stats import average_ranks, dense_index, exact_quantiles, group_row_number


def test_exact_quantiles_narrowing(spark):
    rng = random.Random(7)
    vals = [float(rng.randint(0, 500)) for _ in range(3000)] + [7.0] * 1500  # one value holds a third
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, "x", [0.5, 0.1, 0.9], buckets=8)  # forces narrowing rounds
    want = [float(np.quantile(vals, q)) for q in (0.5, 0.1, 0.9)]
    assert got == want


def test_group_row_number_matches_window(spark):
    rows = [("hot" if i % 3 else f"u{i % 7}", i % 11, i) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, t long, s long")
    mine = group_row_number(df, ["g"], ["t", "s"], "pos")
    w = Window.partitionBy("g").orderBy("t", "s")
    ref = df.withColumn("pos", F.row_number().over(w).cast("bigint"))
    assert mine.exceptAll(ref).count() == 0 and ref.exceptAll(mine).count() == 0


def test_dense_index(spark):
    df = spark.createDataFrame([(f"k{i:04d}",) for i in range(257)], "k string")
    idx = sorted((r.k, r.idx) for r in dense_index(df, "k", "idx").collect())
    assert [i for _, i in idx] == list(range(257))


def _ranks(a):
    order = sorted(range(len(a)), key=lambda i: a[i])
    r = [0.0] * len(a)
    i = 0
    while i < len(a):
        j = i
        while j + 1 < len(a) and a[order[j + 1]] == a[order[i]]:
            j += 1
        for k in range(i, j + 1):
            r[order[k]] = (i + j) / 2 + 1
        i = j + 1
    return r


def test_average_ranks_and_spearman(spark):
    ys = [1.0, 2.0, 2.0, 3.0, 0.0, 2.0, 5.0]
    ss = [0.1, 0.3, 0.3, 0.2, 0.0, 0.9, 0.9]
    df = spark.createDataFrame(list(zip(ys, ss)), "y_true double, y_score double")
    got = sorted((r.y_true, r.r) for r in average_ranks(df, "y_true", "r").collect())
    assert sorted(zip(ys, _ranks(ys))) == got
    sp = rank_correlation(df).first().spearman_correlation
    assert abs(sp - float(np.corrcoef(_ranks(ys), _ranks(ss))[0, 1])) < 1e-12


def _tie_avg_dcg(y, s, k):
    """scikit-learn's tie-averaged DCG (linear gain, log2 discount), k cut-off."""
    disc = [1 / math.log2(i + 2) for i in range(len(y))]
    disc = [d if i < k else 0.0 for i, d in enumerate(disc)]
    order = sorted(range(len(y)), key=lambda i: -s[i])
    total, pos = 0.0, 0
    while pos < len(order):
        end = pos
        while end + 1 < len(order) and s[order[end + 1]] == s[order[pos]]:
            end += 1
        grp = order[pos:end + 1]
        total += np.mean([y[i] for i in grp]) * sum(disc[pos:end + 1])
        pos = end + 1
    return total


def _ndcg(y, s, k):
    ideal = sum(v / math.log2(i + 2) for i, v in enumerate(sorted(y, reverse=True)[:k]))
    return 0.0 if ideal == 0 else _tie_avg_dcg(y, s, k) / ideal


def test_ndcg_and_recall_brute_force(spark):
    rng = random.Random(3)
    rows, users = [], {}
    for u in range(25):
        n = rng.randint(1, 14)
        for j in range(n):
            y, s = float(rng.choice([0, 0, 1, 2, 5])), float(rng.randint(0, 4))
            rows.append((f"u{u}", y, s, j))
            users.setdefault(f"u{u}", []).append((y, s, j))
    df = spark.createDataFrame(rows, "user_id string, y_true double, y_score double, row_id long")
    for k in (5, 10):
        got = {r.user_id: r[f"ndcg_{k}"] for r in ndcg_per_user(df, k).collect()}
        want = {u: _ndcg([a for a, _, _ in v], [b for _, b, _ in v], min(k, len(v))) for u, v in users.items() if len(v) >= 2}
        assert got.keys() == want.keys()
        assert all(abs(got[u] - want[u]) < 1e-12 for u in want)
        rec = {r.user_id: r[f"recall_{k}"] for r in recall_per_user(df, k).collect()}
        for u, v in users.items():
            tot = sum(a for a, _, _ in v)
            if len(v) < 2 or tot <= 0:
                assert u not in rec
                continue
            top = sorted(v, key=lambda t: (-t[1], t[2]))[:k]
            assert abs(rec[u] - sum(a for a, _, _ in top) / tot) < 1e-12


def test_perfect_ranking_is_one(spark):
    df = spark.createDataFrame([("u", 5.0, 3.0, 0), ("u", 2.0, 2.0, 1), ("u", 0.0, 1.0, 2)],
                               "user_id string, y_true double, y_score double, row_id long")
    assert ndcg_per_user(df, 10).first().ndcg_10 == 1.0


def test_exact_medians_batched(spark):
    from plateau.operators.stats import exact_medians
    rng = random.Random(11)
    a = [float(rng.randint(0, 50)) for _ in range(501)]
    b = [float(rng.random()) for _ in range(400)]
    rows = [(a[i] if i < len(a) else None, b[i] if i < len(b) else None) for i in range(max(len(a), len(b)))]
    df = spark.createDataFrame(rows, "a double, b double")
    got = exact_medians(df, ["a", "b"], buckets=16)  # several rounds of narrowing
    assert got == {"a": float(np.median(a)), "b": float(np.median(b))}
