import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plateau.llm import class_lm as X
from plateau.llm.common import prepare
from tests.llm.util import awkward, docs, with_clashes


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def tokens(t):
    return (t or "").encode().lower().split() + [b"\n"]


def corpus(n=500, seed=0):
    """Words of two alternating kinds in two topics."""
    rng = random.Random(seed)
    kinds = [[f"{c}{i}{e}" for i in range(60)] for c, e in (("a", "ing"), ("b", "ed"), ("c", "ung"), ("d", "en"))]
    rows = []
    for i in range(n):
        a, b = rng.choice([(0, 1), (2, 3)])
        rows.append((i, " ".join(rng.choice(kinds[a if j % 2 else b]) for j in range(rng.randrange(1, 80)))))
    return rows


def test_exchange_ends_where_no_single_move_helps():
    rng = np.random.default_rng(0)
    for _ in range(15):
        pairs = rng.integers(0, 6, (9, 9)).astype(float)
        cls = X.exchange(pairs, 3, 30)
        best = X.likelihood(pairs, cls, 3)
        for u in range(9):
            for k in range(3):
                other = cls.copy()
                other[u] = k
                assert X.likelihood(pairs, other, 3) <= best + 1e-9


def likelihood_of(n):
    f = np.vectorize(lambda x: x * math.log(x) if x > 1 else 0.0)
    return f(n).sum() - f(n.sum(0)).sum() - f(n.sum(1)).sum()


def test_counts_classes_and_scores_against_brute_force(spark, monkeypatch):
    """A vocabulary above OWN, most words beyond the ones the tasks know, counters that flush early."""
    for name, size in (("KNOWN", 40), ("OWN", 30), ("UNITS", 60), ("CLASSES", 6), ("FLUSH", 50), ("PENDING", 300)):
        monkeypatch.setattr(X, name, size)
    rows = corpus() + [(i + 1000, t) for i, (_, t) in enumerate(awkward())]
    rows += [(2002 + i, f"new{i}ing other{i}ed a1ing new{i}ing new{i}ing") for i in range(40)]    # words not in training among them
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    train = docs(spark, [r for r in rows if not held(r[0])]).select(X.text_bytes("text").alias("t"))
    lex = X.learn(train)
    table = {bytes(r["word"]): (r["c"], r["k"]) for r in lex.table.collect()}
    assert lex.table.count() == v and {w: x for w, (x, _) in table.items()} == dict(c) and (lex.n, lex.v) == (n, v)
    assert 0 < len(lex.own) <= 30 and 0 < len(lex.known) <= 40 and all(table[w] == x for w, x in lex.known.items())

    unit = X.Units(lex.own)
    pairs, words = np.zeros((X.UNITS, X.UNITS)), Counter()
    for i, t in rows:
        if not held(i):
            seq = [b"\n", *tokens(t)]
            words.update(zip(seq, seq[1:]))
    for (a, b), m in words.items():
        pairs[unit[a], unit[b]] += m
    assert (X.unit_bigrams(train, lex.own) == pairs).all()

    # Every other word: taken out of its class and tried in each, its neighbours (itself among them) where they were.
    now = {w: int(lex.cls[unit[w]]) for w in c}
    grid = np.zeros((6, 6))
    for (a, b), m in words.items():
        grid[now[a], now[b]] += m
    moved = 0
    for w in c:
        if w in lex.own:
            assert table[w][1] == now[w]
            continue
        if (w, w) in words:
            continue
        before, after = np.zeros(6), np.zeros(6)
        for (a, b), m in words.items():
            if b == w:
                before[now[a]] += m
            if a == w:
                after[now[b]] += m
        rest = grid.copy()
        rest[now[w]] -= after
        rest[:, now[w]] -= before
        value = []
        for k in range(6):
            full = rest.copy()
            full[k] += after
            full[:, k] += before
            value.append(likelihood_of(full))
        assert value[table[w][1]] >= max(value) - 1e-6, w
        moved += table[w][1] != now[w]
    assert moved > 20

    klass = {w: k for w, (_, k) in table.items()}
    of = lambda w: klass.get(w, int(lex.cls[unit[w]]))     # noqa: E731
    final, types = np.zeros((6, 6)), Counter(klass.values())
    for (a, b), m in words.items():
        final[klass[a], klass[b]] += m
    source = docs(spark, rows).select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").alias("id"),
                                      X.held_out(F.col("doc_id")).alias("held"), X.text_bytes("text").alias("t"))
    found = X.class_pairs(source, lex)
    assert found.between.count() > 50 and (X.class_bigram(found) == final).all()
    model = X.model_of(final, lex.table)
    assert [model.types[k] for k in range(6)] == [types[k] for k in range(6)] and (model.tokens == final.sum(0)).all()
    assert np.allclose((10 ** model.transition).sum(1), 1)
    mass = np.zeros(6)
    for w, (x, k) in table.items():
        mass[k] += (x + X.DELTA) / (model.tokens[k] + X.DELTA * (model.types[k] + 1))
    assert np.allclose(mass + X.DELTA / (model.tokens + X.DELTA * (model.types + 1)), 1)
    got = {r["id"]: r for r in X.score_documents(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        w, r = tokens(t), got[i]
        k = [of(x) for x in w]
        score = sum(model.transition[a, b] + math.log10((c[x] + X.DELTA) / (model.tokens[b] + X.DELTA * (model.types[b] + 1)))
                    for x, a, b in zip(w, [of(b"\n"), *k], k))
        assert (r["held"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(w), sum(x in c for x in w), n)
        assert abs(r["base"] - sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) < 1e-6
        assert abs(r["score"] - score) < 1e-6


def test_classes_beat_the_base_on_held_out_text(spark):
    got = [r for r in X.score_documents(docs(spark, corpus(800))).collect() if r["held"]]
    assert sum(r["score"] for r in got) > sum(r["base"] for r in got) + 0.1 * sum(r["n_tokens"] for r in got)


def test_awkward_rows(spark):
    rows = awkward()
    got = X.score_documents(with_clashes(docs(spark, rows))).collect()
    assert len(got) == len(rows) and all(math.isfinite(r["score"]) for r in got)
    assert sorted((str(r["id"]), r["n_tokens"]) for r in got) == sorted((str(i), len(tokens(t))) for i, t in rows)
    assert X.score_documents(docs(spark, [])).collect() == []
    only = [r for r in range(100) if held(r)][:2]
    alone = X.score_documents(docs(spark, [(i, "a b") for i in only])).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in alone)
    assert docs(spark, [(None, "x")]).select(X.held_out(F.col("doc_id"))).first()[0] is False


def test_texts_are_worked_on_in_stretches(monkeypatch):
    """Consecutive texts share one array; a text's end stands before its first word and after its last."""
    monkeypatch.setattr(X, "STRETCH", 4)
    texts = [b"a B", b"", b"c", b"d e f g h", b"i"]
    got = list(X.stretches(texts))
    assert [(first, sizes.tolist()) for first, sizes, _ in got] == [(0, [3, 1]), (2, [2, 6]), (4, [2])]
    for first, sizes, words in got:
        before, after = X.neighbours(sizes)
        want = []
        for t in texts[first:first + len(sizes)]:
            w = [X.END, *X.tokens(t), X.END]
            want += zip(w[1:], w[:-1], w[2:] + w[1:2] if len(w) > 2 else w[:1])
        assert [(w, words[b], words[a]) for w, b, a in zip(words, before, after)] == want


def test_few_meetings_are_scored_from_a_table(monkeypatch):
    rng = np.random.default_rng(5)
    n = rng.integers(0, 40, (6, 6)).astype(float)
    at = np.repeat(np.arange(50), 6)
    k = np.concatenate([np.sort(rng.choice(12, 6, replace=False)) for _ in range(50)])
    c, cur = rng.integers(1, 14, len(at)).astype(float), rng.integers(0, 6, 50)
    got = X.best_classes(at, k, c, cur, n, X.small_gains(n))
    monkeypatch.setattr(X, "SMALL", 0)
    assert (got == X.best_classes(at, k, c, cur, n, np.empty((1, 12, 6)))).all()
