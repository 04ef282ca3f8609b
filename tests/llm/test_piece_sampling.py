import math
from collections import Counter

import pytest

from plateau.llm import piece_sampling as X
from plateau.llm.common import prepare
from tests.llm.util import awkward, docs, with_clashes


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def pieces():
    return X.load_pieces()


@pytest.fixture(scope="module")
def lattice(pieces):
    return X.Lattice(pieces)


def every(lattice, pieces, text):
    """All segmentations of a short text with their log probabilities, over the whole text at once."""
    plain = {s: i for i, s, score in pieces if score is not None}
    low = min(plain.values())
    s = (" " + text).replace(X.MARK, "\0").replace(" ", X.MARK)     # a literal mark is no mark
    out = []

    def rec(at, ids, lp):
        if at == len(s):
            out.append((ids, lp))
            return
        for n in range(1, 17):
            x = s[at:at + n]
            if len(x) == n and x in plain:
                rec(at + n, ids + (plain[x],), lp - math.log(plain[x] - low + X.RANK_0))
        if s[at] not in plain:
            b = s[at].replace("\0", X.MARK).encode()
            rec(at + 1, ids + tuple(int(lattice.byte_id[c]) for c in b), lp + len(b) * lattice.byte_weight)
    rec(0, (), 0.0)
    z = math.log(sum(math.exp(x) for _, x in out))
    return {a: x - z for a, x in out}


@pytest.mark.parametrize("text", ["the", "hello", "über日", "ab cd", "x\n▁y", "  a", "\U0001F600", "a\nb \n c", "a  b", "a    ", " \n   b", "     "])
def test_samples_are_distinct_scored_and_decode(lattice, pieces, text):
    prob = every(lattice, pieces, text)
    for i in range(20):
        rows = X.encode_rows(lattice, [i], [text], 6, 1)
        assert len({tuple(r["ids"]) for r in rows}) == len(rows) == min(6, len(prob))
        assert all(abs(prob[tuple(r["ids"])] - r["log_prob"]) < 1e-9 and r["round_trip"] for r in rows)
        assert all(lattice.decode(r["ids"]) == text for r in rows)
        g = [r["gumbel"] for r in rows]
        assert g == sorted(g, reverse=True) and all(0 <= r["inclusion"] <= 1 for r in rows)
        if len(prob) <= 6:
            assert all(r["inclusion"] == 1 for r in rows)


def test_frequencies_are_those_of_sampling_without_replacement(lattice, pieces):
    prob = {a: math.exp(x) for a, x in every(lattice, pieces, "hello").items()}
    n, seen = 4000, [Counter(), Counter(), Counter()]
    for row in X.encode_rows(lattice, list(range(n)), ["hello"] * n, 3, 2):
        seen[row["sample"] - 1][tuple(row["ids"])] += 1
    top = sorted(prob, key=prob.get)[-3:]
    second = {b: sum(prob[a] * prob[b] / (1 - prob[a]) for a in prob if a != b) for b in top}
    third = {c: sum(prob[a] * prob[b] / (1 - prob[a]) * prob[c] / (1 - prob[a] - prob[b])
                    for a in prob for b in prob if len({a, b, c}) == 3) for c in top}
    for a in top:
        for got, want in zip(seen, (prob[a], second[a], third[a])):
            assert abs(got[a] / n - want) < 4 * math.sqrt(want * (1 - want) / n) + 1e-3


def test_inclusion_scores_estimate_totals(lattice, pieces):
    """Sums over samples divided by their inclusion scores are unbiased: the number of pieces, and 1."""
    prob = {a: math.exp(x) for a, x in every(lattice, pieces, "hello").items()}
    n, one, mean = 4000, 0.0, 0.0
    for row in X.encode_rows(lattice, list(range(n)), ["hello"] * n, 2, 5):
        w = math.exp(row["log_prob"]) / row["inclusion"]
        one += w / n
        mean += w * row["n_pieces"] / n
    assert abs(one - 1) < .03 and abs(mean - sum(p * len(a) for a, p in prob.items())) < .06


def test_batches_and_caches_change_nothing(pieces):
    texts = [f"some words {i} here éà " * (i + 1) for i in range(30)]
    ids = list(range(30))

    def all_rows(lat, size):
        return sorted((r for a in range(0, 30, size) for r in X.encode_rows(lat, ids[a:a + size], texts[a:a + size], 3, 0)),
                      key=lambda r: (r["doc_id"], r["sample"]))
    want, warm = all_rows(X.Lattice(pieces), 30), X.Lattice(pieces)
    assert all_rows(warm, 4) == want and all_rows(warm, 7) == want
    assert all_rows(X.Lattice(pieces, cache=50), 1) == want


def test_runs_of_spaces_are_pieces(lattice, pieces):
    """All pieces of the model but control ones can be sampled; a run of spaces is mostly one or two of them."""
    runs = {i for i, s, _ in pieces if len(s) > 1 and not s.strip(X.MARK)}
    assert len(runs) == 14
    rows = X.encode_rows(lattice, list(range(300)), ["a" + " " * 8 + "b"] * 300, 2, 4)
    assert all(r["round_trip"] for r in rows) and sum(bool(runs & set(r["ids"])) for r in rows) > 500
    long = "x" + " " * 5000 + "y" + " " * 300
    assert all(r["round_trip"] and lattice.decode(r["ids"]) == long for r in X.encode_rows(lattice, [1], [long], 2, 4))


def test_operator(spark):
    rows = awkward() + [(70, "no_space" * 20_000)]
    df = with_clashes(docs(spark, rows))
    got = X.sample_segmentations(df, k=3).collect()
    again = X.sample_segmentations(df.repartition(5), k=3).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in got)
    by = Counter(r["doc_id"] for r in got)
    assert by[1] == by[2] == 1 and by[6] == 3 and by[4] == 6
    assert X.sample_segmentations(docs(spark, [])).collect() == []
