"""Decontamination against a plain scan of all windows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateau.llm import decontaminate as D
from tests.llm.util import awkward, docs, with_clashes, words

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(t)


def brute(rows, items, n=10):
    """(id, n_words, n_hit, n_items, digest, contaminated) per row, every window against every place."""
    wins = set()
    for item, text in items:
        ws = split(text)
        k = min(n, len(ws))
        wins |= {(tuple(ws[i:i + k]), item) for i in range(len(ws) - k + 1) if k}
    out = []
    for r in rows:
        ws, hit, named = split(r[1]), set(), set()
        for win, item in wins:
            for s in range(len(ws) - len(win) + 1):
                if tuple(ws[s:s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    if item is not None:
                        named.add(str(item))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((r[0], len(ws), len(hit), len(named), digest, bool(hit)))
    return out


def corpus(rng):
    items = [(i, words(rng, rng.choice([1, 2, 3, 4, 5, 7, 9, 10, 11, 14, 25]), 30 if i % 3 else 4)) for i in range(30)]
    items += [(3, words(rng, 12, 30)), (None, words(rng, 6, 30)), (40, None), (41, ""), (42, " .;- "), (43, items[0][1])]
    rows = []
    for i in range(60):
        parts = [words(rng, rng.randrange(25), 30)]
        for _ in range(rng.randrange(3)):
            ws = split(rng.choice(items)[1])
            a = rng.randrange(len(ws) + 1)
            parts += [" ".join(ws[a:]), rng.choice(["", "q", "," + words(rng, 3, 30)])]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(parts).title() if i % 2 else " ".join(parts)))
    return rows, items


def ran(spark, rows, items, **kw):
    found = D.digest(D.scan(docs(spark, rows), spark.createDataFrame(items, ITEMS), **kw))
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("n,broadcast", [(10, D.BROADCAST), (10, 0), (4, D.BROADCAST), (1, D.BROADCAST)])
def test_equals_all_windows(spark, n, broadcast):
    rows, items = corpus(random.Random(n))
    assert ran(spark, rows, items, n=n, broadcast=broadcast) == sorted(brute(rows, items, n), key=str)


def test_awkward_rows(spark):
    rng = random.Random(5)
    rows = awkward()
    items = [(1, words(rng, 40)), (2, "same row"), (3, rows[8][1][400:900]), (4, "\U0001F600 emoji"), (5, "1 2 3 4 1 555")]
    assert ran(spark, rows, items) == sorted(brute(rows, items), key=str)
    assert ran(spark, rows, []) == sorted(brute(rows, []), key=str)
    assert ran(spark, [], items) == []
    clash = D.digest(D.scan(with_clashes(docs(spark, rows)), with_clashes(spark.createDataFrame(items, ITEMS))))
    assert sorted(map(tuple, clash.collect()), key=str) == sorted(brute(rows, items), key=str)


def test_documents_and_spans_are_removed(spark):
    rng = random.Random(3)
    passage = words(rng, 14, 500)
    item = spark.createDataFrame([(1, passage.upper())], ITEMS)
    rows = [(1, "Keep This, and that."), (2, f"Before it; {passage}, After it."), (2, f"Before it; {passage}, After it."), (3, passage),
            (None, f"({passage}) end"), (5, f"A b {passage}."), (6, None), (7, " ".join(passage.split()[:9])),
            (8, f"x {' '.join(passage.split()[:12])} y {' '.join(passage.split()[3:])} z!")]
    d = with_clashes(docs(spark, rows))
    left = D.decontaminate(d, item)
    assert left.columns == d.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 6, 7]
    clean = D.decontaminate(d, item, remove="spans")
    assert clean.columns == d.columns
    got = sorted((str(r["doc_id"]), r["text"]) for r in clean.select("doc_id", "text").collect())
    assert got == sorted([("1", rows[0][1]), ("2", "Before it, After it."), ("2", "Before it, After it."), ("3", ""), ("None", " end".replace(" ", ") ")),
                          ("5", "A b"), ("6", None), ("7", rows[7][1]), ("8", "x y z!")], key=str)
    with pytest.raises(ValueError):
        D.decontaminate(d, item, remove="lines")


def test_no_python_on_texts(spark):
    plan = D.scan(docs(spark, [(1, "a b")]), spark.createDataFrame([(1, "a")], ITEMS))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_lines_of_a_hot_passage(spark):
    """A passage that a third of the documents hold, and one item word in all of them."""
    rng = random.Random(8)
    passage = words(rng, 30, 900)
    rows = [(i, words(rng, 20, 900) + " " + (passage if i % 3 == 0 else "") + " hot") for i in range(90)]
    items = [(1, passage), (2, "hot"), (3, passage[: len(passage) // 2])]
    assert ran(spark, rows, items) == sorted(brute(rows, items), key=str)
    assert D.digest(D.scan(docs(spark, rows), spark.createDataFrame(items, ITEMS))).filter(F.col("n_hit") == 31).count() == 30
