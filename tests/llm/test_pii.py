import hashlib
import random
import re

import numpy as np
import pytest

from plateau.llm import pii as X
from plateau.llm.common import prepare
from tests.llm.util import awkward, docs, with_clashes, words

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    out = []
    for n, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in v.split(".")),
                    "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), n, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


def check(got, rows):
    assert len(got) == len(rows)
    want = sorted((str(i), hashlib.sha256(",".join(base(t)).encode()).hexdigest(),
                   *(sum(x.startswith(k) for x in base(t)) for k, _ in BASE)) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in got) == want


def soup(rng):
    """Dense in the characters of the patterns."""
    pieces = ["a", "b.c", "@", "@x.y", ".", "-", "_", "%", "+", "+1", "1", "12", "255", "256", "0", ".1", " ", "(5", ")", "4111111111111111",
              "4111 1111 1111 1111", "1.2.3.4", "é", "\U0001F600", "\n", "555-2368", "a@b.c_d@e.f", "000.1.01.1"]
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(30)))


def test_base_spans_against_the_plain_patterns(spark):
    rng = random.Random(6)
    rows = [(i, soup(rng)) for i in range(1500)] + [(9000 + i, t) for i, t in awkward() if i is not None]
    check(X.digest(X.find_pii(docs(spark, rows))).collect(), rows)


def test_awkward_rows_and_clashing_columns(spark):
    rows = awkward() + [(50, "a@b.co " * 3000), (51, "9" * 30_000), (52, "1 " * 20_000), (53, "a@b" + ".c" * 20_000), (54, "a.b" * 10_000 + "@")]
    check(X.digest(X.find_pii(with_clashes(docs(spark, rows)))).collect(), rows)
    assert X.digest(X.find_pii(docs(spark, []))).collect() == []
    (r,) = X.digest(X.find_pii(docs(spark, [(1, "clean text")]))).collect()
    assert r["spans"] == "" and r["n_added"] == 0


def test_added_spans(spark):
    rng, rows = random.Random(2), []
    for i in range(200):
        t = words(rng, 20)
        if i % 4 == 0:
            t += f" call my phone (212) 555-{rng.randrange(1000, 10000)} now "
        if i % 4 == 1:
            t += f" phone +1 (212) 555-{rng.randrange(1000, 10000)} or mail x{i}@mail.example.com "
        if i % 4 == 2:
            t += f" order {rng.randrange(10 ** 7, 10 ** 8)} version 1.2.3 "
        rows.append((i, t))
    got = {r["doc_id"]: r for r in X.digest(X.find_pii(docs(spark, rows))).collect()}
    for i, t in rows:
        spans = [tuple(x.split(":")) for x in got[i]["spans"].split(",") if x]
        assert set(base(t)) <= {":".join(x) for x in spans}
        if i % 4 == 0:
            assert any(k == "phone" and "(212) 555" in t[int(s):int(e)] for k, s, e in spans)
        if i % 4 in (2, 3):
            assert got[i]["n_added"] == 0


def test_loose_addresses_are_candidates_alone(spark):
    """Every text with a match of the loose pattern passes the test before it, whatever else it holds."""
    from pyspark.sql import functions as F
    texts = ["name@host[dot]com", "name@host(dot)com", "name at host.com", "name (at) host dot com", "name[at]host.com", "x at y dot z"]
    df = docs(spark, list(enumerate(texts)))
    found = df.select(F.size(F.regexp_extract_all("text", F.lit(X.LOOSE["email"]), F.lit(0))).alias("n"), X._MAY["loose_email"](F.col("text")).alias("may"))
    assert all(r["n"] == 1 and r["may"] for r in found.collect())


def test_expectation_finds_the_reliable_labelers():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < .6
    votes = np.column_stack([np.where(rng.random(4000) < q, truth, ~truth) * 2 - 1 for q in (.95, .9, .85, .8, .5)])
    rows, n = np.unique(np.column_stack([np.zeros(4000, int), votes]), axis=0, return_counts=True)
    p = dict(zip(map(tuple, rows.tolist()), X.expectation(rows, n.astype(float))))
    guess = np.array([p[(0, *v)] > .5 for v in votes.tolist()])
    assert (guess == truth).mean() > .97


def test_main_path_has_no_python(spark):
    plan = X.digest(X.find_pii(docs(spark, awkward())))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
