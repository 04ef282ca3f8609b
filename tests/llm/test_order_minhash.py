import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plateau.llm import order_minhash as X
from plateau.llm.common import prepare
from tests.llm.util import awkward, docs, with_clashes, words


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def edit_distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def test_band_against_full_alignment():
    rng = random.Random(1)
    for _ in range(1500):
        a = [rng.randint(1, 4) for _ in range(rng.randrange(26))]
        b = list(a)
        for _ in range(rng.randrange(8)):
            b.insert(rng.randrange(len(b) + 1), rng.randint(1, 4))
            if rng.random() < .6:
                del b[rng.randrange(len(b))]
        d, limit = edit_distance(a, b), rng.randrange(12)
        assert X.within_band(np.array(a, np.uint32), np.array(b, np.uint32), limit) == (d <= limit)


def test_order_and_occurrences_count():
    a = b"one two three four five six seven eight nine ten eleven twelve thirteen".split()
    same = X.sketch(X.kmers(a))
    assert (same == X.sketch(X.kmers(list(a)))).all()
    swapped = X.sketch(X.kmers(a[7:] + a[:7]))
    assert (same == swapped).mean() < .2
    h = X.kmers(b"a b c d e a b c d e a b c d e".split())
    assert len(set(h.tolist())) == len(h)


def brute(rows):
    texts = [X.words_of((r[1] or "").encode()) for r in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    links = defaultdict(set)
    for i in range(len(rows)):
        for j in range(i):
            if texts[i] == texts[j]:
                up[find(i)] = find(j)
            elif X.similar(texts[i], texts[j]):
                up[find(i)] = find(j)
                links[b" ".join(texts[i])].add(b" ".join(texts[j]))
                links[b" ".join(texts[j])].add(b" ".join(texts[i]))
    return [find(i) for i in range(len(rows))]


def family(rng, n, size, edits):
    base = words(rng, size).split()
    out = [" ".join(base)]
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(size)] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_classes_against_all_pairs(spark):
    rng = random.Random(3)
    texts = []
    for size, edits, n in ((200, 3, 30), (60, 1, 10), (300, 6, 20), (20, 0, 4), (400, 20, 12)):
        texts += family(rng, n, size, edits)
    passage = words(rng, 60)
    texts += [words(rng, 30, 9000) + " " + passage + " " + words(rng, 30, 9000) for _ in range(60)]
    texts += [words(rng, 80, 9000) for _ in range(60)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    root = brute(rows)
    got = {r["id"]: r for r in X.near_classes(docs(spark, rows)).collect()}
    want = defaultdict(list)
    for (i, _), r in zip(rows, root):
        want[r].append(i)
    for g in want.values():
        assert {got[i]["class_id"] for i in g} == {min(g)}
        assert all(got[i]["class_size"] == len(g) for i in g)
        assert [i for i in g if got[i]["kept"]] == [min(g)]


def test_hub_of_a_large_family(spark):
    """Copies that are similar to their original and not to each other hang together by it."""
    rng = random.Random(8)
    rows = list(enumerate(family(rng, 40, 150, 3)))
    rows = [(100 - i, t) for i, t in rows]     # the original has the largest id
    assert len(set(brute(rows))) == 1
    assert {r["class_id"] for r in X.near_classes(docs(spark, rows)).collect()} == {60}


def test_awkward_rows_and_clashing_columns(spark):
    rows = awkward()
    df = with_clashes(docs(spark, rows))
    got = X.near_classes(df).collect()
    assert len(got) == len(rows)
    n = len(set(brute(rows)))
    assert sum(r["kept"] for r in got) == n
    out = X.dedup_near(df)
    assert out.columns == df.columns and out.count() == n


def test_empty_table(spark):
    assert X.near_classes(docs(spark, [])).collect() == []
    assert X.dedup_near(docs(spark, [])).collect() == []


def shared_passage(rng, pairs, passage):
    """Pairs of short texts over one passage; texts of different pairs are close to similar, but not similar."""
    head = words(rng, passage, 9000)
    texts = []
    for i in range(pairs):
        tail = [f"t{i}x{j}" for j in range(rng.randrange(passage // 8 + 1, passage // 6 + 1))]
        same = max(1, len(tail) - passage // 9)
        texts += [" ".join([head, *tail]), " ".join([head, *tail[:same], *(f"u{i}x{j}" for j in range(len(tail) - same))])]
    return texts


@pytest.mark.parametrize("passage", [100, 200])
def test_pairs_that_meet_only_in_large_buckets(spark, passage):
    rng = random.Random(11)
    n = 120
    texts = [X.words_of(t.encode()) for t in shared_passage(rng, n, passage)]
    assert all(X.similar(texts[2 * i], texts[2 * i + 1]) for i in range(n))
    assert not any(X.similar(texts[2 * i], texts[2 * j]) for i in range(n) for j in range(0, i, 7))
    rows = [(i, b" ".join(t).decode()) for i, t in enumerate(texts)]
    got = {r["id"]: r["class_id"] for r in X.near_classes(docs(spark, rows)).collect()}
    lost = sum(got[2 * i] != got[2 * i + 1] for i in range(n))
    assert lost == 0
    assert len(set(got.values())) == n


@pytest.mark.parametrize("refs", ["one", "own", "mixed", "far"])
def test_near_pairs_against_all_pairs(spark, refs):
    """Whatever the nodes are compared with, every pair of similar sets is met; labels may already join some."""
    import zstandard
    rng = random.Random(12)
    texts = [*shared_passage(rng, 25, 100), *family(rng, 12, 60, 1), *family(rng, 12, 40, 2),
             *("a b c d e f g h i".split()[:n] for n in (2, 4, 5, 6, 8, 9))]
    texts = [(" ".join(t) if isinstance(t, list) else t).encode().split() for t in texts]
    turn = texts[50][30:] + texts[50][:30]                     # the same shingles but four, in another order
    texts += [turn, turn[:-1]]
    node = [f"{i:03d}".encode() for i in range(len(texts))]
    packed = spark.createDataFrame([(x, bytearray(zstandard.compress(b" ".join(t)))) for x, t in zip(node, texts)], "node binary, z binary")
    ref = {"one": [node[0]] * len(node), "own": node, "mixed": [node[i - i % 7] for i in range(len(node))],
           "far": [node[51 if i >= 50 else 0] for i in range(len(node))]}[refs]
    label = [node[0] if refs == "mixed" and i < 4 else x for i, x in enumerate(node)]
    of = dict(zip(node, label))
    rows = spark.createDataFrame([(x, of[x], r, of[r]) for x, r in zip(node, ref)], "node binary, label binary, ref binary, ref_label binary")
    got = {tuple(sorted((bytes(r["node"]), bytes(r["hub"])))) for r in X._near_pairs(rows, packed).collect()}
    want = {(node[j], node[i]) for i in range(len(texts)) for j in range(i)
            if of[node[i]] != of[node[j]] and X.jaccard(texts[i], texts[j]) >= X.SIMILARITY}
    assert want and want <= got


@pytest.mark.parametrize("original", [True, False])
def test_candidates_of_a_family_stay_few(spark, monkeypatch, original):
    """Near copies with changes of their own: classes equal all pairs, and the pairs brought together after the hubs grow
    with the family, not with its square."""
    seen = []
    near = X._near_pairs
    monkeypatch.setattr(X, "_near_pairs", lambda *a: seen.append(near(*a).cache()) or seen[-1])
    rng = random.Random(21)
    base = words(rng, 100, 9000).split()
    texts = [" ".join(base)] if original else []
    for _ in range(160):
        t = list(base)
        for at in rng.sample(range(100), 2):
            t[at] = f"c{rng.randrange(10 ** 6)}"
        texts.append(" ".join(t))
    rows = list(enumerate(texts))
    root = brute(rows)
    got = {r["id"]: r["class_id"] for r in X.near_classes(docs(spark, rows)).collect()}
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min(least.get(r, i), i)
    assert all(got[i] == least[r] for (i, _), r in zip(rows, root))
    assert sum(x.count() for x in seen) < 4 * len(rows)


def test_short_texts_always_meet(spark):
    """Sizes around the number of picks, one word more or less."""
    rng = random.Random(13)
    texts = []
    for i in range(60):
        w = [f"s{i}x{j}" for j in range(13)]
        n = 8 + i % 5
        texts += [w[:n], w[:n + 1]]
    for i in range(20):     # few shingles, repeated
        w = [f"r{i}"] * 5 if i % 2 else [f"r{i}", f"q{i}"] * 3
        texts += [w, w + w[:1]]
    texts = [" ".join(t).encode().split() for t in texts]
    assert all(X.similar(texts[i], texts[i + 1]) for i in range(0, len(texts), 2))
    rows = [(i, b" ".join(t).decode()) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = {r["id"]: r["class_id"] for r in X.near_classes(docs(spark, rows)).collect()}
    assert [i for i in range(0, len(texts), 2) if got[i] != got[i + 1]] == []
    assert len(set(got.values())) == len(texts) // 2


def test_short_keys_differ_by_one():
    w = [f"w{j}".encode() for j in range(20)]
    for n in range(5, 14):
        a, b = set(X.short_keys(w[:n]).tolist()), set(X.short_keys(w[:n + 1]).tolist())
        assert bool(a & b) == (8 <= n < 13)
    assert len(X.short_keys(w)) == 0 and len(X.short_keys([])) == 0


def test_swept_cuts_leave_no_files_of_earlier_ones(spark):
    """The files of earlier cuts' exchanges go although the driver's heap is far from full."""
    import time

    from plateau.llm.common import cut_swept

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x for x in (found.apply(i).getName() for i in range(found.size())) if x.startswith("shuffle_")}
    old, out, first = files(), spark.range(2000).withColumnRenamed("id", "k"), set()
    for _ in range(4):
        out = cut_swept(out.repartition(3, "k").groupBy((F.col("k") % 7).alias("k")).count().select("k"))
        first = first or files() - old
        time.sleep(0.3)
    assert first and not first & files() and out.count() == 7
