import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from plateau.llm import toxicity as X
from plateau.llm.common import prepare
from tests.llm.util import awkward, docs, with_clashes, words

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                       T.StructField("toxic", T.IntegerType())])
BAD = ["grobble", "snark", "vexon"]


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w, toxic, junk = words(rng, rng.randrange(20, 200)).split(), rng.random() < .2, rng.random() < .2
        if toxic:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        text = " ".join(w).upper() + "!!" if junk and not toxic else " ".join(w)
        rows.append((i, text))
        labels.append((i, int(not (junk and not toxic)), int(toxic)))
    return rows, labels


def test_chain_separates_held_out_documents(spark):
    rows, labels = corpus()
    chain = X.fit(docs(spark, rows[:300]), spark.createDataFrame(labels, LABELS))
    got = {r["id"]: r for r in X.score(docs(spark, rows[300:]), chain).collect()}
    right = sum(got[i]["rejected"] == bool(t) for i, _, t in labels[300:])
    assert right >= 97
    assert sum((got[i]["p_low_quality"] > .5) == (not q) for i, q, _ in labels[300:]) >= 97


def test_distributed_scores_equal_local_ones(spark):
    rows, labels = corpus(150, 2)
    chain = X.fit(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    text = {i: (t or "").encode() for i, t in rows}
    for r in X.score(docs(spark, rows), chain).collect():
        assert np.allclose([r["p_low_quality"], r["p_toxic"]], chain.predict(text[r["id"]]))


def test_later_models_see_earlier_categories():
    """The second category is the first one's: its word features alone are noise."""
    rng = np.random.default_rng(0)
    n = 300
    y = rng.integers(0, 2, n)
    words_ = [np.sort(rng.choice(np.arange(10, 400, dtype=np.uint32), 30, replace=False)) for _ in range(n)]
    words_ = [np.sort(np.r_[w, np.uint32(5)]) if k else w for w, k in zip(words_, y)]
    chain = X.fit_rows(words_, rng.standard_normal((n, 8)), {"a": y.astype(float), "b": y.astype(float)})
    assert len(chain.links[1].center) == 9 and abs(chain.links[1].weights[-2]) > 0.5


def test_no_labels_one_class_and_awkward_rows(spark):
    rows = awkward()
    df = with_clashes(docs(spark, rows))
    for labels in ([], [(1, 1, 0), (2, 1, 0), (12, None, 1), (None, 1, 1)], [(6, 1, 0), (6, 1, 1), (12, 0, 0), (4, 1, 0)]):
        chain = X.fit(df, spark.createDataFrame(labels, LABELS))
        got = X.score(df, chain).collect()
        assert len(got) == len(rows) and all(0 <= r["p_toxic"] <= 1 for r in got)
        kept = X.keep_clean(df, chain)
        assert kept.columns == df.columns and kept.count() == sum(not r["rejected"] for r in got)
        if len(labels) < 3 or labels[0][0] == 1:
            assert kept.count() == len(rows)
    assert X.score(docs(spark, []), chain).collect() == [] and X.keep_clean(docs(spark, []), chain).collect() == []


def test_sample_is_bounded_and_seeded(spark):
    rows, labels = corpus(200, 3)
    a = X.fit(docs(spark, rows), spark.createDataFrame(labels, LABELS), sample=60)
    b = X.fit(docs(spark, rows).repartition(7), spark.createDataFrame(labels[::-1], LABELS), sample=60)
    assert all(np.allclose(x.weights, y.weights) for x, y in zip(a.links, b.links))


def _plain_features(text):
    """Words and shape of a text, character by character."""
    raw = text.encode()
    kept = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in raw)
    found = [w for w in re.split(rb"[ ]+", kept) if w]
    n, k, lines = len(raw) + 1, len(found) + 1, raw.split(b"\n")
    upper = sum(65 <= b <= 90 for b in raw)
    digit = sum(48 <= b <= 57 for b in raw)
    punct = sum(33 <= b <= 126 and not chr(b).isalnum() for b in raw)
    return set(found), [math.log(k), len(set(found)) / k, len(raw) / k / 10, 10 * upper / n, 10 * digit / n, 10 * punct / n,
                        len(set(lines)) / len(lines), math.log(n / len(lines))]


def _plain_model(rows, y):
    """Logistic regression of (words, dense features) rows by many small Newton steps; returns a logit function."""
    n, pos = len(rows), sum(y)
    z = {}
    for w in set().union(*(r[0] for r in rows)):
        cell = {(a, b): 0 for a in (0, 1) for b in (0, 1)}
        for r, label in zip(rows, y):
            cell[int(w in r[0]), label] += 1
        g = 0.0
        for (a, b), seen in cell.items():
            expected = sum(v for (p, _), v in cell.items() if p == a) * (pos if b else n - pos) / n
            g += 2 * seen * math.log(seen / expected) if seen else 0.0
        z[w] = math.sqrt(max(0.0, g))
    vocab = [w for w in sorted(z, key=lambda w: (-z[w], zlib.crc32(w)))[:256] if z[w] >= 4]
    dense = [list(column) for column in zip(*(r[1] for r in rows))]
    mean = [sum(c) / n for c in dense]
    dev = [math.sqrt(sum((v - m) ** 2 for v in c) / n) + 1e-9 for c, m in zip(dense, mean)]

    def line(r):
        return [float(w in r[0]) for w in vocab] + [min(3.0, max(-3.0, (v - m) / d)) for v, m, d in zip(r[1], mean, dev)] + [1.0]
    x, t = np.array([line(r) for r in rows]), np.array(y, float)
    ridge = np.array([1.0] * len(vocab) + [10.0] * 8 + [1.0] * (len(mean) - 8) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 0.5 * np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge), x.T @ (p - t) + ridge * w)
    return lambda r: min(30.0, max(-30.0, float(np.dot(line(r), w))))


def test_chain_equals_a_plain_one(spark):
    """An independent chain: features by loops, four folds, the second category on out-of-fold logits of the first."""
    rows, labels = corpus(160, 5)
    text = dict(rows)
    order = sorted(text, key=lambda i: (zlib.crc32(str(i).encode()), i))
    low, toxic = ({i: v for i, v in zip([r[0] for r in labels], vs)} for vs in ([1 - r[1] for r in labels], [r[2] for r in labels]))
    x = {i: _plain_features(t) for i, t in rows}
    assert all(X.features(text[i].encode())[1] == pytest.approx(x[i][1]) for i in order)

    def out_of_fold(rows_of, y):
        out = {}
        for f in range(4):
            rest = [i for k, i in enumerate(order) if k % 4 != f]
            model = _plain_model([rows_of[i] for i in rest], [y[i] for i in rest])
            out |= {i: model(rows_of[i]) for k, i in enumerate(order) if k % 4 == f}
        return out
    first = _plain_model([x[i] for i in order], [low[i] for i in order])
    oof = out_of_fold(x, low)
    longer = {i: (x[i][0], x[i][1] + [oof[i]]) for i in order}
    second = _plain_model([longer[i] for i in order], [toxic[i] for i in order])
    oof2 = out_of_fold(longer, toxic)
    chain = X.fit(docs(spark, rows), spark.createDataFrame(labels, LABELS))

    # The least logit that is rejected lies where F1 over the out-of-fold logits is best.
    def f1(limit):
        hit = sum(toxic[i] for i in order if oof2[i] >= limit)
        return 2 * hit / (sum(oof2[i] >= limit for i in order) + sum(toxic.values()))
    limit = chain.links[-1].threshold
    assert f1(math.log(limit / (1 - limit))) >= max(f1(v) for v in oof2.values()) - 1e-9
    for r in X.score(docs(spark, rows), chain).collect():
        a = first(x[r["id"]])
        b = second((x[r["id"]][0], x[r["id"]][1] + [a]))
        assert abs(r["p_low_quality"] - 1 / (1 + math.exp(-a))) < 2e-3 and abs(r["p_toxic"] - 1 / (1 + math.exp(-b))) < 2e-3
        assert r["rejected"] == (r["p_toxic"] >= limit)


def test_documents_that_share_an_id_are_one_row_of_the_sample(spark):
    rows, labels = corpus(120, 6)
    many = rows + [(i, t) for i, t in rows for _ in range(2)] + [(i, t + " zzz later text") for i, t in rows]
    a = X.fit(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    b = X.fit(docs(spark, many).repartition(5), spark.createDataFrame(labels * 2, LABELS))
    assert all(np.allclose(x.weights, y.weights) for x, y in zip(a.links, b.links))
