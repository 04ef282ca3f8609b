"""Clustering with ns-bounds against full searches in every round."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from plateau.llm import centroid_clusters as C
from tests.llm.util import with_clashes

VECS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     T.StructField("label", T.IntegerType())])


def brute(rows, k=16, rounds=3, dim=64):
    kept = []
    for i, v in rows:
        if v is None or len(v) != dim or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    cents = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]
    for _ in range(rounds):
        of = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, a) in zip(kept, of) if a == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    of = assign()
    inertia = {j: sum(d for d, a in of if a == j) for j in range(len(cents))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, a, d, inertia[a], sum(inertia.values()), sha[a]) for (i, _), (d, a) in zip(kept, of)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECS)


def ran(df, **kw):
    found, history = C.cluster(df, **kw)
    return sorted(map(tuple, C.digest(found, history[-1]).collect()), key=str)


def blobs(rng, n, dim=64, centres=9):
    mids = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    return [(i, [m + rng.gauss(0, 0.4) for m in rng.choice(mids)]) for i in range(n)]


def test_equals_full_search(spark):
    rng = random.Random(1)
    rows = blobs(rng, 400) + [(i, [0.25] * 64) for i in range(1000, 1150)]      # one vector in a quarter of the rows
    assert ran(frame(spark, rows)) == sorted(brute(rows), key=str)
    assert ran(frame(spark, rows), rounds=0) == sorted(brute(rows, rounds=0), key=str)
    assert ran(frame(spark, rows).repartition(7), rounds=6) == sorted(brute(rows, rounds=6), key=str)


def test_ties_and_small_whole_numbers(spark):
    rng = random.Random(4)
    rows = [(i, [rng.randrange(-1, 2) / 64 for _ in range(64)]) for i in range(60)]
    rows += [(i, rows[i % 7][1]) for i in range(60, 100)]
    assert ran(frame(spark, rows), rounds=5) == sorted(brute(rows, rounds=5), key=str)


def test_awkward_rows(spark):
    rng = random.Random(2)
    good = blobs(rng, 30)
    rows = good + [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [1.0] * 63), (105, [float("nan")] + [1.0] * 63),
                   (106, [float("inf")] + [1.0] * 63), (107, [0.0] * 64), (None, [0.5] * 64), (None, [0.5] * 64), (3, good[3][1]), (3, [0.75] * 64),
                   (108, [-1e5] * 64)]
    want = sorted(brute(rows), key=str)
    assert ran(frame(spark, rows)) == want
    assert ran(with_clashes(frame(spark, rows))) == want
    assert ran(frame(spark, rows[:5])) == sorted(brute(rows[:5]), key=str)          # fewer vectors than centroids
    assert ran(frame(spark, [])) == []
    assert ran(frame(spark, rows[30:34])) == []
    assert ran(frame(spark, [(1, [3e6] * 64)])) == []                               # beyond what a squared distance can hold


@pytest.mark.parametrize("seed", range(4))
def test_bounds_never_settle_wrongly(seed):
    """States over many rounds of moving centroids: assignments equal the full search, with fewer measurements."""
    rng = np.random.default_rng(seed)
    mids = rng.integers(-300, 300, (12, 64))
    x = mids[rng.integers(0, 12, 600)] + rng.integers(-40, 40, (600, 64))
    history = [x[:12].copy()]
    a, best, n, low, at = C.first_state(x, history[0])
    measured = 0
    for t in range(9):
        now = np.array([x[a == j].sum(0) // max(1, (a == j).sum()) if (a == j).any() else history[-1][j] for j in range(12)])
        history.append(now)
        a, best, n, low, at = C.next_state(x, a, low, at, history)
        measured += int(n.sum())
        full = ((x[:, None] - now[None]) ** 2).sum(2)
        assert (a == full.argmin(1)).all()
        assert ((best < 0) | (best == full.min(1))).all()
    assert measured < 0.5 * 9 * 600 * 12


def test_whole_way_is_tighter_than_steps():
    """A centroid that goes and comes back has no way to loosen by, whatever its steps sum to."""
    x = np.zeros((1, 64), np.int64)
    far = np.full((1, 64), 50)
    c0 = np.concatenate([x, far])
    a, _, _, low, at = C.first_state(x, c0)
    away = np.concatenate([x, far + 400])
    a, _, n1, low, at = C.next_state(x, a, low, at, [c0, away])
    a, _, n2, low, at = C.next_state(x, a, low, at, [c0, away, c0])
    assert a[0] == 0 and n2[0] == 0
