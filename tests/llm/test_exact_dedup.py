import hashlib
import random
from collections import defaultdict

import pytest

from plateau.llm import exact_dedup as X
from plateau.llm.common import SPACE, prepare
from tests.llm.util import awkward, docs, with_clashes


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def brute(rows):
    groups = defaultdict(list)
    for i, (doc, text, *_) in enumerate(rows):
        z = (text or "").encode().translate(None, SPACE)
        groups[z].append((-len(text or ""), doc is None, doc or 0, i, doc))
    out = []
    for z, g in groups.items():
        keep = min(g[:], key=lambda r: r[:3])
        out += [(doc, keep[4], len(g), hashlib.sha256(z).hexdigest()) for *_, doc in g]
    return sorted(out, key=str), sum(1 for _ in groups)


def check(spark, rows, df=None, **kw):
    got = X.exact_groups(df if df is not None else docs(spark, rows), **kw).collect()
    want, n = brute(rows)
    assert sorted(((r["id"], r["keep_id"], r["group_size"], r["sha"]) for r in got), key=str) == want
    assert sum(r["kept"] for r in got) == n
    return got


def test_fingerprints_compose():
    fp, rng = X.Fingerprint(), random.Random(1)
    for n in (0, 1, 4095, 4096, 4097, 50_000, 300_001):
        a, b = rng.randbytes(n), rng.randbytes(rng.randrange(9000))
        assert fp.combine(fp.of(a), fp.of(b), len(b)) == fp.of(a + b)
    data = rng.randbytes(5000)
    for j, base in enumerate(fp.bases):
        h = 0
        for c in data:
            h = (h * base + c) % fp.prime
        assert fp.of(data)[j] == h


def test_chunked_comparison():
    a = bytes(range(256)) * 1000
    assert X.same(a, bytes(a)) and not X.same(a, a[:-1] + b"x") and not X.same(a, a[:-1])


def test_awkward_rows_and_clashing_columns(spark):
    rows = awkward()
    check(spark, rows, with_clashes(docs(spark, rows)))


def test_empty_table(spark):
    assert X.exact_groups(docs(spark, [])).collect() == []
    assert X.dedup_exact(docs(spark, [])).collect() == []


def test_collisions_are_split(spark):
    """A fingerprint of three values puts different texts together; the comparison tells them apart."""
    rows = [(i, f"text {i % 7} {'ab' * (i % 2)}") for i in range(120)]
    check(spark, rows, prime=3, bases=(2, 2))


def test_levels_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(X, "FAN", 3)
    rows = [(i, "the same  text" if i % 2 else "the same text") for i in range(200)] + [(i, f"own {i}") for i in range(200, 220)]
    check(spark, rows)
    check(spark, rows + [(300, "thesametexu")], prime=2, bases=(1, 1))


def test_dedup_keeps_one_row_each_with_its_columns(spark):
    rows = awkward()
    df = with_clashes(docs(spark, rows))
    out = X.dedup_exact(df)
    assert out.columns == df.columns
    texts = [(r["text"] or "").encode().translate(None, SPACE) for r in out.collect()]
    assert len(texts) == len(set(texts)) == brute(rows)[1]
