import numpy as np
import pytest
from pyspark.sql import functions as F

from plateau.llm import collision_ann as X
from plateau.llm.common import prepare

SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute(rows, k=10):
    ok = {}
    for i, v in rows:
        if i is None or v is None or None in v or not np.isfinite(v).all() or not any(v):
            continue
        v32 = tuple(np.float32(v).tolist())
        ok[i] = min(ok.get(i, v32), v32)
    out = {}
    for q, v in ok.items():
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((np.array(v) - np.array(u)) ** 2).sum())), i) for i, u in ok.items()
                          if i != q and len(u) == len(v))[:k]
            out[q] = near
    return out


def run(df, **kw):
    got = {}
    for r in sorted(X.nearest(df, F.col("vec_id") % 100 == 0, **kw).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def recall(got, want):
    hit = sum(len({i for _, i in got.get(q, [])} & {i for _, i in w}) for q, w in want.items())
    return hit / sum(map(len, want.values()))


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centers = rng.standard_normal((20, 48))
    rows = [(i, (centers[i % 20] + .6 * rng.standard_normal(48)).astype(np.float32).tolist()) for i in range(3000)]
    got, want = run(frame(spark, rows), block=700, chunk=16), brute(rows)
    assert recall(got, want) >= .9
    scores = {(q, i): d for q, w in brute(rows, 3000).items() for d, i in w}
    assert all(abs(scores[q, i] - d) < 1e-12 * max(1, d) for q, g in got.items() for d, i in g)


def test_copies_ties_and_few_candidates(spark):
    rng = np.random.default_rng(2)
    common = rng.standard_normal(8).tolist()
    rows = [(i, common) for i in range(400)] + [(i, rng.standard_normal(8).tolist()) for i in range(400, 420)]
    assert run(frame(spark, rows))[100] == [(0.0, i) for i in range(10)]
    got = run(frame(spark, rows), block=3)
    assert got == {q: w for q, w in brute(rows).items()}
    small = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])]
    assert run(frame(spark, small)) == brute(small)


def test_awkward_vectors_and_columns(spark):
    bad = [(0, [1.0, 2.0]), (100, None), (200, [0.0, 0.0]), (300, [1.0, None]), (400, [float("nan"), 1.0]), (None, [1.0, 1.0]),
           (500, [float("inf"), 1.0]), (600, []), (1, [1.0, 2.0]), (2, [2.0, 2.0]), (2, [2.0, 2.0]), (3, [1.0, 2.0, 3.0]),
           (700, [1.0, 2.0, 3.5]), (-100, [5.0, 5.0])]
    df = frame(spark, bad).select("*", *[F.lit(1).alias(c) for c in ("id", "v", "q", "rn", "b", "c", "dim", "rank", "score", "_q")])
    want = {q: w for q, w in brute(bad).items() if w}
    assert run(df) == want
    assert X.nearest(frame(spark, []), F.lit(True)).collect() == []
