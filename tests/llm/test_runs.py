"""Periodic runs against their definition."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from plateau.llm import runs as R
from plateau.llm.queries import periodic_tail
from tests.llm.util import awkward, docs, with_clashes


def brute_lyndon(s):
    out = []
    for i in range(len(s)):
        best = 1
        for j in range(i + 1, len(s) + 1):
            w = s[i:j]
            if all(w < w[k:] for k in range(1, len(w))):
                best = j - i
        out.append(best)
    return out


def brute_runs(words, min_len=24, min_exp=3):
    """Maximal stretches of every period, the smallest period of each stretch."""
    found = {}
    n = len(words)
    for q in range(1, n // min_exp + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_len, min_exp * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2], hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def repetitive(rng, n):
    """Words with runs inside runs, over few or many different words."""
    out = []
    while len(out) < n:
        kind = rng.randrange(5)
        if kind == 0:
            out += [f"w{rng.randrange(200)}" for _ in range(rng.randrange(1, 30))]
        elif kind == 1:
            root = [f"r{rng.randrange(3)}" for _ in range(rng.randrange(1, 12))]
            out += root * rng.randrange(2, 9) + root[:rng.randrange(len(root) + 1)]
        elif kind == 2 and out:
            a = rng.randrange(len(out))
            out += out[a:a + 40] * rng.randrange(1, 5)
        elif kind == 3:
            out += ["z"] * rng.randrange(40)
        else:
            out += [rng.choice("ab") for _ in range(rng.randrange(30))]
    return out[:n]


@pytest.mark.parametrize("sigma", [1, 2, 3, 6])
def test_lyndon_arrays(sigma):
    rng = random.Random(sigma)
    for n in [0, 1, 2, 3, *range(4, 40)]:
        s = [rng.randrange(sigma) for _ in range(n)]
        if n % 3 == 0 and n > 5:
            s = (s[:n // 4 + 1] * 5)[:n]
        assert R.lyndon_array(s, sigma) == brute_lyndon(s)
        t = [sigma - 1 - x for x in s]
        assert R.lyndon_array(t, sigma) == brute_lyndon(t)


@pytest.mark.parametrize("min_len,min_exp", [(24, 3), (6, 3), (2, 3), (4, 2), (10, 4)])
def test_runs_equal_the_definition(min_len, min_exp):
    rng = random.Random(min_len * 10 + min_exp)
    for n in [0, 1, 5, 23, 24, 25, *[rng.randrange(26, 260) for _ in range(60)]]:
        words = [w.encode() for w in repetitive(rng, n)]
        assert R.word_runs(words, min_len, min_exp) == brute_runs(words, min_len, min_exp)


def test_thin_texts_of_two_words():
    for n in range(0, 14):
        for bits in range(1 << n) if n < 11 else random.Random(n).sample(range(1 << n), 500):
            words = [b"a" if bits >> i & 1 else b"b" for i in range(n)]
            assert R.word_runs(words, 3, 3) == brute_runs(words, 3, 3)
            assert R.word_runs(words, 2, 2) == brute_runs(words, 2, 2)


def test_weak_hashes_change_nothing(monkeypatch):
    monkeypatch.setattr(R, "MODULI", (5,))
    rng = random.Random(2)
    for _ in range(30):
        w = np.array([hash(x) % 1000 for x in repetitive(rng, 150)])
        assert R.piece_runs(w, 24, 3) == set(brute_runs(w.tolist(), 24, 3))


def test_query_rows(spark):
    rng = random.Random(7)
    rows = awkward() + [(100 + i, " ".join(repetitive(rng, rng.randrange(200))) + rng.choice(["", "  x", "\x0b tail"])) for i in range(80)]
    rows += [(300, "word " * 3000), (301, " ".join(["a b"] * 12)), (302, " ".join(["a b"] * 11))]
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0] is not None)
    want = sorted((brute_row(*r[:2]) for r in rows), key=str)
    d = docs(spark, rows)
    assert sorted(map(tuple, R.digest(R.find_runs(d, rewrite=periodic_tail)).collect()), key=str) == want
    clash = R.digest(R.find_runs(with_clashes(d).repartition(5), rewrite=periodic_tail))
    assert sorted(map(tuple, clash.collect()), key=str) == want
    assert R.digest(R.find_runs(docs(spark, []), rewrite=periodic_tail)).collect() == []


def test_collapsed_texts(spark):
    d = docs(spark, [(1, "x " + "spam eggs " * 20 + "y"), (2, None), (3, "plain  text")])
    got = {r["id"]: r["collapsed"] for r in R.find_runs(d, texts=True).collect()}
    assert got == {1: "x spam eggs y", 2: "", 3: "plain text"}
