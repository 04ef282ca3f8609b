"""The learner against plain loops: gradients, metrics, trees, importance, search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plateau.config import RankerParams
from plateau.operators import boosting as B
from plateau.operators import ranker as RK
from plateau.operators.evaluate import ndcg_per_user


def groups(rng, sizes, grades=(0.0, 0.0, 0.1, 1.0, 3.5, 5.0)):
    start = np.concatenate([[0], np.cumsum(sizes)])
    label = rng.choice(grades, start[-1])
    return start, label, rng.permutation(10 * start[-1] + 1)[:start[-1]].astype(np.int64)


def pair_loop(start, label, score, key, truncation, norm):
    """Every pair of a user's rows, one by one."""
    g, h = np.zeros(len(label)), np.zeros(len(label))
    for a, b in zip(start[:-1], start[1:]):
        rows = sorted(range(a, b), key=lambda i: (-score[i], key[i]))
        ideal = sorted((label[i] for i in rows), reverse=True)[:truncation]
        best = sum(y / math.log2(p + 2) for p, y in enumerate(ideal))
        if best <= 0:
            continue
        total, own_g, own_h = 0.0, {}, {}
        for p, i in enumerate(rows):
            for q in range(p + 1, len(rows)):
                j = rows[q]
                if p >= truncation or label[i] == label[j]:
                    continue
                hi, lo = (i, j) if label[i] > label[j] else (j, i)
                gap = score[hi] - score[lo]
                w = (label[hi] - label[lo]) * abs(1 / math.log2(p + 2) - 1 / math.log2(q + 2)) / best
                if norm and score[rows[0]] != score[rows[-1]]:
                    w /= 0.01 + abs(gap)
                x = 1 / (1 + math.exp(gap))
                for k, sign in ((hi, -1), (lo, 1)):
                    own_g[k] = own_g.get(k, 0) + sign * x * w
                    own_h[k] = own_h.get(k, 0) + x * (1 - x) * w
                total += 2 * x * w
        scale = math.log2(1 + total) / total if norm and total > 0 else 1.0
        for k in own_g:
            g[k], h[k] = own_g[k] * scale, own_h[k] * scale
    return g, h


@pytest.mark.parametrize("truncation,norm", [(30, True), (5, True), (30, False), (1, False)])
def test_gradients_equal_the_pair_loop(truncation, norm):
    rng = np.random.default_rng(truncation)
    start, label, key = groups(rng, [1, 0, 2, 50, 7, 1, 33, 40])
    label[start[4]:start[5]] = 0.0                                   # a user without gain
    for score in (np.zeros(len(label)), rng.normal(size=len(label)), rng.integers(0, 4, len(label)) / 2.0):
        got, want = B.lambda_gradients(start, label, score, key, truncation, norm), pair_loop(start, label, score, key, truncation, norm)
        assert np.allclose(got[0], want[0], atol=1e-12) and np.allclose(got[1], want[1], atol=1e-12)
        for a, b in zip(start[:-1], start[1:]):
            assert abs(got[0][a:b].sum()) < 1e-9                     # what one row gains another loses


def test_ndcg_equals_the_frame_form(spark):
    rng = np.random.default_rng(3)
    start, label, _ = groups(rng, [1, 2, 30, 12, 5])
    label[start[4]:] = 0.0
    score = rng.integers(0, 5, len(label)).astype(float)
    user = np.repeat(np.arange(5), np.diff(start))
    df = spark.createDataFrame([(f"u{u}", float(y), float(s)) for u, y, s in zip(user, label, score)], "user_id string, y_true double, y_score double")
    got = B.ndcg_sums(start, label, score, (5, 10, 20))
    for k, x in zip((5, 10, 20), got):
        row = ndcg_per_user(df, k).agg(F.sum(f"ndcg_{k}"), F.count("user_id")).first()
        assert abs(x - row[0]) < 1e-9 and got[-1] == row[1]
    assert got[-2] == sum(b - a >= 2 and label[a:b].max() > 0 for a, b in zip(start[:-1], start[1:]))


def brute_tree(x, g, h, p, features):
    """Best-first growth by scores of every cut of every node; (threshold code, gain) per split in order and the leaves' rows."""
    def shrunk(v):
        return math.copysign(max(abs(v) - p.lambda_l1, 0.0), v)

    def worth(rows):
        return shrunk(g[rows].sum()) ** 2 / (h[rows].sum() + p.lambda_l2)

    def best(rows):
        found = None
        for f in features:
            for c in range(int(x[f].max())):
                a, b = rows[x[f, rows] <= c], rows[x[f, rows] > c]
                if min(len(a), len(b)) < p.min_child_samples or min(h[a].sum(), h[b].sum()) < B.MIN_HESSIAN:
                    continue
                gain = worth(a) + worth(b) - worth(rows)
                if gain > 1e-9 and (found is None or gain > found[0] + 1e-12):
                    found = (gain, f, c, a, b)
        return found
    leaves = [(np.arange(x.shape[1]), best(np.arange(x.shape[1])))]
    splits = []
    while len(leaves) < p.num_leaves:
        open_ = [i for i, (_, b) in enumerate(leaves) if b]
        if not open_:
            break
        i = max(open_, key=lambda k: leaves[k][1][0])
        _, (gain, f, c, a, b) = leaves.pop(i)
        splits.append((f, c, round(gain, 8)))
        leaves += [(a, best(a)), (b, best(b))]
    return splits, {tuple(sorted(r.tolist())): -shrunk(g[r].sum()) / (h[r].sum() + p.lambda_l2) for r, _ in leaves}


@pytest.mark.parametrize("small", [0, 60, 10_000])
def test_trees_equal_exhaustive_best_first_growth(small, monkeypatch):
    """Whatever is measured ahead, sent as rows or taken by subtraction, the tree is the one of plain best-first growth."""
    monkeypatch.setattr(B, "SMALL", small)
    rng = np.random.default_rng(small)
    for leaves in (2, 3, 7, 15):
        p = RankerParams(num_leaves=leaves, min_child_samples=8, lambda_l1=0.2, lambda_l2=0.5, learning_rate=0.1)
        x = rng.integers(0, 9, (4, 400)).astype(np.uint8)
        g = rng.normal(size=400) + (x[1] > 5) * 2 - (x[2] < 2) * (x[0] > 3)
        h = rng.random(400) + 0.01
        chosen = [0, 1, 3] if leaves == 7 else [0, 1, 2, 3]

        class Local:
            def __init__(self):
                self.p = p

            def measure(self, shape, nodes, fetch, features):
                leaf = shape.leaf_of(x)
                hists = [B.histogram(x, features, np.flatnonzero(leaf == n), np.zeros((leaf == n).sum(), int), g, h, 1, 9)[0] for n in nodes]
                return np.array(hists), [(i, x[np.ix_(features, leaf == n)], g[leaf == n], h[leaf == n]) for i, n in enumerate(fetch)]
        root = B.histogram(x, chosen, np.arange(400), np.zeros(400, int), g, h, 1, 9)[0]
        tree = B.grow(Local(), root, chosen)
        splits, parts = brute_tree(x, g, h, p, chosen)
        found = sorted((tree.shape.feature[n], tree.shape.code[n], round(v, 8)) for n, v in tree.gain.items())
        assert found == sorted(splits)
        leaf = tree.shape.leaf_of(x)
        got = {tuple(np.flatnonzero(leaf == n).tolist()): v for n, v in tree.value.items()}
        assert got.keys() == parts.keys() and all(abs(got[k] - 0.1 * parts[k]) < 1e-9 for k in parts)


def learnable(spark, users=60, items=25, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(f"u{u:02d}", f"r{i}", float(v > .7), float(v + .1 * rng.standard_normal()), float(rng.standard_normal()))
            for u in range(users) for i, v in enumerate(rng.random(items))]
    return spark.createDataFrame(rows, "user_id string, recipe_id string, label double, a double, b double")


def test_fit_is_the_same_in_any_layout(spark):
    """Blocks, partitions and row order change nothing; the scorer over values gives what the codes gave."""
    df = learnable(spark)
    tr, va = df.filter("user_id < 'u40'"), df.filter("user_id >= 'u40'")
    p = RankerParams(min_child_samples=5, num_leaves=8, learning_rate=.3, early_stopping_rounds=3)
    one = RK.fit_ranker(tr, va, ["a", "b"], p, rounds=5)
    B.BLOCK, old = 100, B.BLOCK
    try:
        two = RK.fit_ranker(tr.repartition(7, "recipe_id"), va.repartition(3), ["a", "b"], p, rounds=5)
    finally:
        B.BLOCK = old
    assert [(t.feature, t.threshold) for t in one.scorer.trees] == [(t.feature, t.threshold) for t in two.scorer.trees]
    assert np.allclose([h["val_ndcg"] for h in one.history], [h["val_ndcg"] for h in two.history])
    scored = RK.score_frame(va, one.scorer).select("user_id", F.col("label").alias("y_true"), F.col("score").alias("y_score"))
    for k in (5, 10, 20):
        assert abs(ndcg_per_user(scored, k).agg(F.avg(f"ndcg_{k}")).first()[0] - one.history[one.best_round - 1][f"val_ndcg_{k}"]) < 1e-9


def test_importance_is_the_gain_of_the_kept_trees(spark):
    df = learnable(spark)
    res = RK.fit_ranker(df, None, ["a", "b"], RankerParams(min_child_samples=5, num_leaves=6), rounds=3)
    want = {"a": 0.0, "b": 0.0}
    for t in res.scorer.trees:
        assert len(t.gain) == len(t.feature) and all((g > 0) == (f >= 0) for f, g in zip(t.feature, t.gain))
        for f, g in zip(t.feature, t.gain):
            if f >= 0:
                want[["a", "b"][f]] += g
    assert res.importance == want and want["a"] > want["b"]
    top = RK.feature_importance(res, 1).collect()
    assert [(r["feature"], r["importance"]) for r in top] == [("a", want["a"])]


def test_odd_rows(spark):
    """Nulls and NaN anywhere, repeated rows, one-row users, a user with most rows, no rows."""
    rows = [("hot", float(i % 4 == 0), float(i % 4 == 0) + i / 1000, None if i % 7 == 0 else 1.0) for i in range(900)]
    rows += [(None, 1.0, float("nan"), 2.0), (None, 0.0, 0.5, float("nan")), ("one", 1.0, 0.1, 0.1), ("x", None, 0.2, 0.3), ("x", 1.0, 0.9, 0.3)]
    rows += [("same", 1.0, 0.7, 0.7)] * 50
    df = spark.createDataFrame(rows, "user_id string, label double, a double, b double")
    res = RK.fit_ranker(df, df, ["a", "b"], RankerParams(min_child_samples=20, num_leaves=4, bagging_fraction=.5), rounds=3)
    assert res.history[-1]["val_ndcg"] > 0.4 and res.scorer.trees
    assert RK.score_frame(df.select("a", "b"), res.scorer).filter("score IS NULL OR isnan(score)").count() == 0
    for empty in (RK.fit_ranker(df.limit(0), df, ["a"], rounds=3), RK.fit_ranker(df, df.limit(0), [], rounds=3)):
        assert empty.scorer.trees == [] and empty.history == []
    alone = RK.fit_ranker(df, df.limit(0), ["a"], rounds=2)                          # no validation rows: all rounds stay
    assert len(alone.scorer.trees) == 2 and "val_ndcg" not in alone.history[0]
    flat = df.withColumn("label", F.lit(0.0))
    assert RK.fit_ranker(flat, flat, ["a", "b"], rounds=3).scorer.trees == []        # nothing to gain


def test_samples(spark):
    key = np.arange(20_000, dtype=np.int64) * 7919
    share = [B._drawn(key, 42, t, 0.8).mean() for t in range(3)]
    assert all(abs(s - 0.8) < 0.02 for s in share)
    assert (B._drawn(key, 42, 0, 0.8) != B._drawn(key, 42, 1, 0.8)).any()
    assert len(B.chosen_features(28, 0.7, 1, 0)) == 20 and B.chosen_features(28, 0.7, 1, 0) != B.chosen_features(28, 0.7, 1, 1)
    assert B.chosen_features(1, 0.1, 0, 0) == [0]


def test_proposals_move_to_good_trials():
    rng = np.random.default_rng(0)
    trials = []
    for t in range(60):
        p = RK.propose(trials, rng)
        for k, (lo, hi, kind) in RK.SEARCH_SPACE.items():
            assert lo <= p[k] <= hi and (kind != "int" or isinstance(p[k], int))
        trials.append({"params": p, "val_ndcg": -abs(math.log(p["learning_rate"] / 0.05)) - abs(p["feature_fraction"] - 0.8)})
    late = [t["val_ndcg"] for t in trials[40:]]
    assert np.mean(late) > np.mean([t["val_ndcg"] for t in trials[:10]]) + 0.2
    d = RK.Parzen([0.2, 0.25, 0.9])
    grid = np.linspace(0, 1, 4001)
    assert abs(np.exp(d.log_density(grid)).mean() - 1) < 0.01


def test_search_ends_by_patience_and_saves(spark, tmp_path):
    df = learnable(spark, 30, 12)
    tr, va = df.filter("user_id < 'u20'"), df.filter("user_id >= 'u20'")
    out = str(tmp_path / "params")
    best, trials = RK.tune(tr, va, n_trials=6, rounds=3, patience=2, features=["a", "b"], save_to=out)
    scores = [t["val_ndcg"] for t in trials]
    assert len(trials) <= 6 and best == trials[int(np.argmax(scores))]["params"]
    if len(trials) < 6:
        assert max(scores[:-2]) >= max(scores[-2:]) - 1e-12
    params, score = RK.load_params(spark, out)
    assert score == max(scores) and params.learning_rate == best["learning_rate"] and params.early_stopping_rounds == RankerParams().early_stopping_rounds


def test_a_settled_fit_keeps_the_trees_of_the_whole_one(spark):
    rows = [(f"u{u}", f"i{i}", float(i % 3), float(i % 3), float((u * 7 + i) % 5)) for u in range(30) for i in range(12)]
    df = spark.createDataFrame(rows, "user_id string, recipe_id string, label double, a double, b double")
    p = RankerParams(min_child_samples=5, num_leaves=4, early_stopping_rounds=6)
    whole = RK.fit_ranker(df, df, ["a", "b"], p)
    short = RK.fit_ranker(df, df, ["a", "b"], p, stop=RK.settled)
    assert short.best_round == whole.best_round and short.scorer.to_json() == whole.scorer.to_json() and short.importance == whole.importance
    assert len(whole.history) == whole.best_round + 6 and len(short.history) == short.best_round


def test_packing_many_features_stays_small_in_the_optimizer(spark):
    names = [f"x{i}" for i in range(10)]
    df = spark.createDataFrame([("u", 1.0, *map(float, range(10))), ("u", 0.0, *[None] * 10), ("v", 2.0, *[0.5] * 10)],
                               "user_id string, label double, " + ", ".join(f"{c} double" for c in names))
    edges = B.cut_points(df, names)
    packed = B.pack(df, names, edges, "user_id", "label", 2)
    # every renamed feature would double the equalities that the optimizer keeps of the key
    assert packed._jdf.queryExecution().optimizedPlan().toString().count(" AS ") <= 3
    rows = packed.unionAll(B.pack(df, names, edges, "user_id", "label", 1)).collect()
    assert sum(r.n for r in rows) == 6 and all(len(r.codes) == 10 * r.n for r in rows)
