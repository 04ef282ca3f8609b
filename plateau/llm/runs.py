"""Periodic runs of words by Baier grouping: the first phase of his suffix sorter gives the Lyndon arrays of a text under
an order of its words and under the reverse order; their Lyndon roots, extended through longest common extensions, are the runs.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, of at least ``min_len``
words and ``min_exp`` periods. Every run has a root, a Lyndon word under one of the two orders, that is the longest Lyndon word at
each place in the run where it stands whole (the order under which the word that breaks the run is the smaller one).
A run of three periods shows its root twice in a row, so candidates are the places with the same Lyndon length one length later.

* ``lyndon_array``: suffixes are grouped by their first word. Groups are taken from the largest down; the nearest
  place to the left of a member whose group is still to come takes the member's Lyndon word on: places that do so l
  times move to a new group just above their own, longer by l words. At the end a group's length is the length of its
  members' longest Lyndon word. Places of groups that are done leave a linked list, so the nearest place is one step away,
  and the phase is linear in the text.
* ``extensions``: how far the words before and after a root repeat, for all candidates at once by bisection over
  polynomial hashes of prefixes (two moduli). Every run found is then compared word by word, so no result rests on a hash.

Before that a text falls apart at every word that occurs fewer times than a run has whole periods (each word of a run
occurs once per period): no run holds such a word, nor ends beside one that would extend it. The pieces fall apart in the same
way until nothing changes; what is left of ordinary prose is short and is dropped below ``min_len``. This changes no result.

Documents are independent: each is worked on inside the task that reads it, nothing is shuffled, and a task holds
one Arrow batch (bounded in rows and bytes) and one document's arrays.

Defined results: null, empty and white-space-only texts have no words and no runs; a null id or repeated row gives a row like
any other; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import batches, column_of, text_bytes

MIN_LEN = 24
MIN_EXP = 3
MODULI = ((1 << 31) - 1, (1 << 31) - 19)
BASE = 1_000_003


def lyndon_array(s: list[int], sigma: int) -> list[int]:
    """Length of the longest Lyndon word that begins at each place of ``s`` (numbers below ``sigma``)."""
    n = len(s)
    members: list[list[int]] = [[] for _ in range(sigma)]
    for i, c in enumerate(s):
        members[c].append(i)
    group, length = list(s), [1] * sigma
    below, above = list(range(-1, sigma - 1)), list(range(1, sigma + 1))
    above[-1] = -1
    # left and right are the neighbours among the places whose groups are still to come; n + 1 stands for none.
    left, right = list(range(-1, n)), list(range(1, n + 2))
    g = sigma - 1
    while g >= 0:
        counts: dict[int, int] = {}
        for i in members[g]:           # ascending, so the places on the left come in ascending order too
            if group[i] == g:
                a, b = left[i], right[i]
                left[b] = a
                if a >= 0:
                    right[a] = b
                    counts[a] = counts.get(a, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for p, times in counts.items():
            moves.setdefault((times, group[p]), []).append(p)
        size = length[g]
        for times, old in sorted(moves, reverse=True) if len(moves) > 1 else moves:
            new, up = len(members), above[old]
            places = moves[times, old]
            members.append(places)
            length.append(length[old] + times * size)
            below.append(old)
            above.append(up)
            above[old] = new
            below[up] = new            # a group below g always has one above it
            for p in places:
                group[p] = new
        g = below[g]
    return [length[x] for x in group]


class Extensions:
    """Longest common extensions of pairs of places in one array, many at a time."""

    def __init__(self, w: np.ndarray):
        self.n, self.tables = len(w), []
        for m in map(np.uint64, MODULI):
            power = np.ones(1, np.uint64)
            step = np.uint64(BASE)
            while len(power) <= self.n:                       # B ** 0 .. B ** (2 ** k - 1)
                power = np.concatenate([power, power * step % m])
                step = step * step % m
            power = power[:self.n + 1]
            h = np.zeros(self.n + 1, np.uint64)
            h[1:] = np.cumsum((w.astype(np.uint64) + np.uint64(1)) * power[:self.n] % m) % m
            self.tables.append((m, power, h))

    def _same(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether w[i:i + size] and w[j:j + size] have equal hashes (i < j)."""
        out = np.ones(len(i), bool)
        for m, power, h in self.tables:
            a = (h[i + size] + m - h[i]) % m * power[j - i] % m
            out &= a == (h[j + size] + m - h[j]) % m
        return out

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and from j on (i < j)."""
        return self._widest(self.n - j, lambda size: self._same(i, j, size))

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree before i and before j (i < j)."""
        return self._widest(i.copy(), lambda size: self._same(i - size, j - size, size))

    @staticmethod
    def _widest(most: np.ndarray, holds: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        low, high = np.zeros_like(most), most
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = holds(mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def _whole(w: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """The stretch of period p around [i, i + p), word by word."""
    start, end = i, i + p
    while end < len(w) and w[end] == w[end - p]:
        end += 1
    while start > 0 and w[start - 1] == w[start - 1 + p]:
        start -= 1
    return start, end


def piece_runs(w: np.ndarray, min_len: int = MIN_LEN, min_exp: int = MIN_EXP) -> set[tuple[int, int, int]]:
    """(start, length, period) of all runs of an array of whole numbers."""
    kinds, w = np.unique(w, return_inverse=True)
    found: set[tuple[int, int, int]] = set()
    roots: list[tuple[int, int]] = []
    reach = None
    for order in (w, len(kinds) - 1 - w):
        size = np.array(lyndon_array(order.tolist(), len(kinds)))
        times = 2 if min_exp >= 3 else 1                      # how often the root stands in a row
        at = np.flatnonzero(np.arange(len(w)) + times * size <= len(w) - (times == 1))
        at = at[w[at] == w[at + size[at]]]
        if times == 2:
            at = at[(size[at + size[at]] == size[at]) & (w[at + size[at] - 1] == w[at + 2 * size[at] - 1])]
        if not len(at):
            continue
        reach = reach or Extensions(w)
        p = size[at]
        lead, tail = reach.before(at, at + p), reach.after(at, at + p)
        total = lead + p + tail
        good = total >= np.maximum(min_len, min_exp * p)      # a hash can only make it longer
        found |= set(zip((at - lead)[good].tolist(), total[good].tolist(), p[good].tolist()))
        roots += zip(at[good].tolist(), p[good].tolist())
    if all(_is_run(w, *x) for x in found):
        return found
    exact = ((*_whole(w, i, p), p) for i, p in roots)         # two hashes agreed by chance
    return {(a, b - a, p) for a, b, p in exact if b - a >= max(min_len, min_exp * p)}


def _is_run(w: np.ndarray, start: int, size: int, p: int) -> bool:
    end = start + size
    return bool(np.array_equal(w[start:end - p], w[start + p:end]) and (start == 0 or w[start - 1] != w[start - 1 + p])
                and (end == len(w) or w[end] != w[end - p]))


def _pieces(codes: np.ndarray, need: int, min_len: int):
    """(from, to) of the pieces whose words all occur ``need`` times in them."""
    todo = [(0, len(codes))]
    while todo:
        a, b = todo.pop()
        if b - a < min_len:
            continue
        _, place, count = np.unique(codes[a:b], return_inverse=True, return_counts=True)
        rare = np.flatnonzero((count < need)[place])
        if not len(rare):
            yield a, b
            continue
        edges = np.concatenate([[-1], rare, [b - a]])
        wide = np.flatnonzero(np.diff(edges) > min_len)
        todo += [(a + int(edges[k]) + 1, a + int(edges[k + 1])) for k in wide]


def word_runs(words: list[bytes], min_len: int = MIN_LEN, min_exp: int = MIN_EXP) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text, by start and period."""
    if len(words) < min_len:
        return []
    known: dict[bytes, int] = {}
    codes = np.array([known.setdefault(x, len(known)) for x in words])
    need = max(2, int(min_exp))
    common = np.bincount(codes) >= need
    if np.diff(np.flatnonzero(np.concatenate([[True], ~common[codes], [True]]))).max() <= min_len:
        return []
    return sorted(((a + s, n, p) for a, b in _pieces(codes, need, min_len) for s, n, p in piece_runs(codes[a:b], min_len, min_exp)),
                  key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: each run keeps its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, n, p in runs:
        step[start + p] += 1
        step[start + n] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


_OUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()),
                  ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                  ("collapsed_sha256", pa.string()), ("collapsed", pa.binary())])
_DDL = ("id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed_sha256 string, "
        "collapsed binary")


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = MIN_LEN, min_exp: int = MIN_EXP,
              rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None, texts: bool = False) -> DataFrame:
    """One row per document: id, n_words, runs (by start and period), the SHA-256 of the collapsed words with a space between, and,
    with ``texts``, collapsed itself. ``rewrite`` may change a document's words beforehand."""
    def run(it):
        def rows():
            for b in it:
                for i, t in zip(column_of(b, "id"), column_of(b, "t")):
                    words = t.split()
                    if rewrite is not None:
                        words = rewrite(i, words)
                    runs = word_runs(words, min_len, min_exp)
                    left = b" ".join(collapse(words, runs))
                    yield (i, len(words), [{"start": s, "length": n, "period": p} for s, n, p in runs],
                           hashlib.sha256(left).hexdigest(), left if texts else None)
        yield from batches(rows(), _OUT, 200 if texts else 2000)

    d = docs.select(F.col(id_col).cast("bigint").alias("id"), text_bytes(text_col).alias("t")).mapInArrow(run, _DDL)
    return d.withColumn("collapsed", F.col("collapsed").cast("string")) if texts else d.drop("collapsed")


def _longest() -> Column:
    """The first of the sorted runs with the greatest length / period, compared as whole numbers."""
    return F.aggregate(F.slice("runs", F.lit(2), F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)),
                       lambda z, x: F.when(x["length"] * z["period"] > z["length"] * x["period"], x).otherwise(z))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_runs``."""
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", *[x[c].cast("string") for c in ("start", "length", "period")]),
                                                   F.lit("\n")))
    d = found.withColumn("top", F.when(F.size("runs") > 0, _longest()))
    return d.select(F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), "top.start", "top.length", "top.period",
                    F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256")
