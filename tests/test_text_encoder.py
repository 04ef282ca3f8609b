"""Text features never merge terms, whatever their alphabet."""

import math
import random
from collections import Counter, defaultdict

import pytest

from plateau.operators import text as T

SCHEMA = "recipe_id string, author_id string, tags string, recipe_name string, description string"
ROWS = [("1", "a", "['x']", "red fox", "red_fox runs red fox"), ("2", None, None, None, "красная лиса и синяя лиса"),
        ("3", "a", "x, y", "Red Fox", "red fox RED_FOX"), ("4", "b", "", "", None)]


def test_display_names_are_unique_and_keep_every_feature():
    got = T.display_names(["t_red fox", "t_red_fox", "T_red-fox", "t_лиса", "t_синяя", "t_" + "x" * 90, "t_" + "x" * 91])
    assert len(set(n.lower() for n in got.values())) == len(got) == 7
    assert got["t_red fox"] == "t_red_fox" and got["t_red_fox"] == "t_red_fox_2"


def brute_tfidf(texts):
    import re
    terms = {}
    for i, t in texts.items():
        w = re.findall(r"\b\w\w+\b", (t or "").lower())
        terms[i] = Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    df = Counter(x for c in terms.values() for x in c)
    out = {}
    for i, c in terms.items():
        w = {x: n * (math.log((1 + len(texts)) / (1 + df[x])) + 1) for x, n in c.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out |= {(i, "d_" + x): v / norm for x, v in w.items()}
    return out


def test_tfidf_of_colliding_terms(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.recipe_id, r.feature): r.value for r in T.tfidf_transform(df, "description", T.fit_tfidf(df, "description", 500), "d_").collect()}
    want = brute_tfidf({r[0]: r[4] for r in ROWS})
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_wide_form_equals_long_form(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    specs = (*T.DEFAULT_ENCODERS, T.Encoder("description", "tfidf", "d_", 500))
    enc = T.TextEncoder(specs).fit(df.select("recipe_id"), df)
    wide = {r["recipe_id"]: r.asDict() for r in enc.transform(df).collect()}
    names = enc.feature_names(df)
    assert len(set(n.lower() for n in names.values())) == len(names)
    long = {(r.recipe_id, r.feature): r.value for r in enc.transform_long(df).collect()}
    for i in wide:
        for f, n in names.items():
            assert wide[i][n] == pytest.approx(long.get((i, f), 0.0))
    assert wide["1"]["author_id_freq"] == 0.5 and wide["2"]["author_id_freq"] == 0.25
    enc.save(str(tmp_path / "enc"))
    back = T.TextEncoder.load(spark, str(tmp_path / "enc"), specs)
    assert {tuple(r) for r in back.transform_long(df).collect()} == {tuple(r) for r in enc.transform_long(df).collect()}


def brute_terms(rows, most, min_df):
    cf, df = Counter(), defaultdict(set)
    for i, text in rows:
        w = text.split()
        for t in w + [f"{a} {b}" for a, b in zip(w, w[1:])]:
            cf[t] += 1
            df[t].add(i)
    best = sorted((t for t in cf if len(df[t]) >= min_df), key=lambda t: (-cf[t], t))[:most]
    return {(t, len(df[t])) for t in best}


def test_top_terms_against_counting_all(spark):
    """Ties at the last place, words that are frequent in one document only, ids that repeat or are null."""
    rng = random.Random(3)
    words = ["aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh"]
    rows = [(rng.choice(["1", "2", "3", None]), " ".join(rng.choices(words, range(1, 9), k=rng.randint(0, 7)))) for _ in range(12)]
    rows += [("9", " ".join(["zz"] * 50 + ["yy"] * 40 + ["xx"] * 30)), ("8", "zz")]
    df = spark.createDataFrame(rows, "recipe_id string, description string")
    for most, min_df in [(3, 1), (5, 3), (9, 2), (20, 1), (500, 2), (500, 1)]:
        got = {(r.term, r.df) for r in T.fit_tfidf(df, "description", most, min_df).collect()}
        assert got == brute_terms(rows, most, min_df), (most, min_df)


def test_terms_are_counted_where_the_texts_are(spark, monkeypatch):
    """No exchange carries the terms of a text: the texts travel once, by id."""
    df = spark.createDataFrame([("1", "red fox red"), ("2", "blue fox")], "recipe_id string, description string")
    monkeypatch.setattr(T, "TASK_ROWS", 1)
    vocab = spark.createDataFrame(T.fit_tfidf(df, "description", 5).collect(), "term string, df bigint, idf double")
    for out in (T.tfidf_transform(df, "description", vocab, "d_"), T.hash_encode(df, "description", 64, "h_")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(recipe_id" in plan
