import random

import pytest

from plateau.llm import licenses as X
from plateau.llm.common import prepare
from tests.llm.util import awkward, docs, with_clashes, words


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def brute(text):
    """Templates contained in some window of their length, widened as the operator widens it."""
    w, out = X.words_of((text or "").encode()), set()
    for name, t in X.TEMPLATES.items():
        tw = X.words_of(t.encode())
        size, step = min(X.SHINGLE, len(tw)), max(1, len(tw) // X.STEP)
        parts = X.shingles(tw, size)
        if w and max(len(X.shingles(w[max(0, i - step):i + len(tw) + step], size) & parts) / len(parts)
                     for i in range(max(1, len(w) - len(tw) + 1))) >= X.CONTAINMENT:
            out.add(name)
    return out


def noisy(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = "zzz"
    return " ".join(w)


def test_matches_against_all_windows(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        t = words(rng, rng.randrange(0, 120))
        for name in rng.sample(sorted(X.TEMPLATES), rng.randrange(3)):
            t += " " + noisy(rng, X.TEMPLATES[name], rng.randrange(3)) + "\n" + words(rng, rng.randrange(40))
        rows.append((i, t))
    got = {}
    for r in X.scan_licenses(docs(spark, rows)).collect():
        got.setdefault(r["doc_id"], set()).add(r["license_id"])
        assert r["containment"] >= X.CONTAINMENT and r["n_matches"] >= 1
    wrong = [(i, got.get(i, set()) ^ brute(t)) for i, t in rows if got.get(i, set()) != brute(t)]
    # Windows are tried every few words, so a match at the very edge of the threshold may differ.
    assert len(wrong) <= 3
    assert all(brute(t) >= got.get(i, set()) for i, t in rows)


def test_places_cases_and_long_texts(spark):
    text = words(random.Random(1), 30_000) + " LICENSED under-the apache license, version 2.0."
    (r,) = X.scan_licenses(docs(spark, [(1, text)])).collect()
    assert (r["license_id"], r["first_word"], r["end_word"], r["containment"]) == ("Apache-2.0", 30_000, 30_008, 1.0)


def test_retrieval_probability():
    """Windows at Jaccard 2/3 or more with a template share a band nearly always."""
    rng, missed = random.Random(9), 0
    for i in range(300):
        a = [f"w{rng.randrange(10 ** 6)}".encode() for _ in range(40)]
        b = a[:33] + [f"v{j}{i}".encode() for j in range(7)]
        x, y = (X.Scanner._bands(X.signature(X.shingle_hashes(w))) for w in (a, b))
        missed += not any(p == q for p, q in zip(x, y))
    assert missed <= 2


def test_awkward_rows(spark):
    df = with_clashes(docs(spark, awkward() + [(None, X.TEMPLATES["MIT"]), (20, X.TEMPLATES["MIT"]), (20, X.TEMPLATES["MIT"])]))
    got = X.scan_licenses(df).collect()
    assert sorted((r["doc_id"] or 0, r["license_id"]) for r in got) == [(0, "MIT"), (20, "MIT"), (20, "MIT")]
    assert X.scan_licenses(docs(spark, [])).collect() == []


def test_license_lines_of_the_documents(spark):
    lines = {"All rights reserved.": "all-rights-reserved-line", "Released under the MIT License.": "MIT",
             "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    rng = random.Random(6)
    rows = [(i, words(rng, 40) + "\n" + line) for i, line in enumerate(lines)]
    got = {r["doc_id"]: r["license_id"] for r in X.scan_licenses(docs(spark, rows)).collect()}
    assert got == dict(enumerate(lines.values()))
