import random
from collections import Counter, defaultdict

import pytest

from plateau.llm import mixing as X
from plateau.llm.common import prepare
from tests.llm.util import awkward, docs, with_clashes


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def targets(sizes):
    """Water-filling by repeated resharing."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in free)
        share = {s: left * weight[s] / w for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {**{s: 3.0 * sizes[s] for s in capped}, **share}
        capped |= above


def size(t):
    return len((t or "").encode().split())


def plan(spark, rows, df=None):
    got = [tuple(r) for r in X.mix_plan(df if df is not None else docs(spark, rows))
           .select("id", "source", "size", "source_size", "target", "copies", "taken").collect()]
    want = Counter((r[0], r[2] if len(r) > 2 else "s", size(r[1])) for r in rows)
    assert Counter((i, s, n) for i, s, n, *_ in got) == want
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2] if len(r) > 2 else "s"] += size(r[1])
    t = targets(sizes) if rows else {}
    for i, s, n, total, target, copies, taken in got:
        assert total == sizes[s] and abs(target - t[s]) < 1e-6 * max(1, t[s]) and taken == copies * n and 0 <= copies <= 3
    return got, t


def test_plan_meets_targets(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(1, 300), rng.choice(["a", "a", "a", "b", "c", "é", "Z", None])) for i in range(600)]
    got, t = plan(spark, rows)
    taken = defaultdict(int)
    for r in got:
        taken[r[1]] += r[6]
    for s in t:
        assert abs(taken[s] - t[s]) <= 1
    assert sorted(got, key=str) == sorted(plan(spark, rows)[0], key=str)


def test_awkward_rows_and_clashing_columns(spark):
    rows = [(*r, ["x", "y", None][i % 3]) for i, r in enumerate(awkward())]
    df = with_clashes(docs(spark, rows))
    got, _ = plan(spark, rows, df)
    out = X.mixed(df)
    assert out.columns == df.columns
    assert Counter((r["doc_id"], r["source"]) for r in out.collect()) == Counter(
        {k: v for k, v in sum((Counter({(g[0], g[1]): g[5]}) for g in got), Counter()).items() if v})


def test_empty_table_and_no_words(spark):
    assert X.mix_plan(docs(spark, [])).collect() == []
    assert all(r["taken"] == 0 and r["target"] == 0 for r in X.mix_plan(docs(spark, [(1, ""), (2, None, "b")])).collect())


def test_subset_sums_against_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        total = sum(s * n for s, n in counts.items())
        budget = rng.randrange(0, total + 5)
        take = X.fit_subset(dict(counts), budget)
        assert all(0 <= take.get(s, 0) <= n for s, n in counts.items())
        got = sum(s * k for s, k in take.items())
        # The proportional share stays; the rest must be the best bounded knapsack.
        first = {s: n * budget // total for s, n in counts.items()} if budget < total else counts
        sums = {sum(s * k for s, k in first.items())}
        for s, n in counts.items():
            sums = {x + s * k for x in sums for k in range(n - first[s] + 1)}
        assert got == max(x for x in sums if x <= budget)


def test_large_budget_uses_the_window():
    counts = {s: 50 for s in range(1, 900, 7)}
    total = sum(s * n for s, n in counts.items())
    take = X.fit_subset(counts, total * 2 // 3 + 1)
    assert sum(s * k for s, k in take.items()) == total * 2 // 3 + 1
    assert all(take[s] <= 50 for s in take)
