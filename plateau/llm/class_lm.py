"""Scores under a Brown class-based bigram model: P(w_t | w_t-1) = P(c_t | c_t-1) * P(w_t | c_t).

Tokens are the words of a text (``[^\\x20\\x09-\\x0D]+``, A-Z lowered) and one end; the end of the
text before stands for a start. Counts cover every training document. Classes come from exchange clustering of the
whole vocabulary in two steps. First units are exchanged in turn: each of the ``OWN`` most frequent words (counted wherever
they hold one of ``SHARE`` tokens of a stretch of text) by itself, the other words together by a hash of their last three bytes; a unit moves to the class that raises the
class-bigram likelihood most, until a pass moves none or ``PASSES`` are done. Then every other word of the corpus
leaves its unit: tasks count the classes before and after each word over all training documents, the counts of a
word are summed by a sorted stream, and the word moves to the class that raises the likelihood most, its neighbours
staying where they are (a distributed exchange: all words move at once). ``OWN`` therefore bounds what the
driver exchanges, not which words have a class of their own choice; the lexicon (word, count, class) grows with the corpus.

P(c2 | c1) interpolates the class bigram with the smoothed class frequency; P(w | c) is additive
over the class's words and one unknown word, so both sum to one. A word that training never saw has the class of its unit.

Scoring: the ``KNOWN`` most frequent words carry their counts and classes to the tasks, which count the class pairs of each
document. A rarer word is a row (document, word, class before, class after, times) that is joined with the lexicon, two of them side by
side also a row of both words, joined twice; the lexicon is never collected. The class pairs of the training documents then give the transitions, and
those of all documents their scores.

Defined results: null and empty texts are one end token; a null id counts as the id '' when the held-out
rows are dealt; repeated rows are separate documents; without training documents all counts are
0; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import batches, column_of, cut, text_bytes
from plateau.session import checkpoint_dir

UNITS, OWN = 2048, 1536
SHARE = 200_000
CLASSES = 64           # at most 128
PASSES = 4
KNOWN = 131_072        # words whose counts and classes go to every task, at most
FLUSH = 400_000        # distinct words a counting task holds before it emits them
PENDING = 2_000_000    # (word, class) meetings a task holds before it sums them
DELTA, KEEP = 1.0, 0.95
STRETCH = 100_000      # tokens of consecutive documents that a task works on at once, about
SMALL = 8              # meetings up to this number are scored from a table
END = b"\n"            # no word holds white space


def tokens(t: bytes) -> list[bytes]:
    return t.lower().split()   # bytes: lowers A-Z alone and splits at the contract's white space


def stretches(texts: list[bytes]):
    """(first text, sizes, tokens) of consecutive texts; each text's tokens are followed by its end."""
    first, sizes, words = 0, [], []
    for t in texts:
        w = tokens(t)
        words += w
        words.append(END)
        sizes.append(len(w) + 1)
        if len(words) >= STRETCH:
            yield first, np.array(sizes), words
            first, sizes, words = first + len(sizes), [], []
    if sizes:
        yield first, np.array(sizes), words


def neighbours(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the token before and after each; a text's end also stands before its first word."""
    ends = np.cumsum(sizes)
    n = int(ends[-1])
    before, after = np.arange(-1, n - 1), np.arange(1, n + 1)
    before[ends - sizes], after[ends - 1] = ends - 1, ends - sizes
    return before, after


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def frequent_counts(train: DataFrame) -> DataFrame:
    """(word, c) over all training texts (column t); the end counts once per text. A task counts stretches of FLUSH
    distinct words and leaves out the words below one of SHARE tokens of the stretch."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def count(it):
        def rows():
            seen: Counter = Counter()

            def often():
                least = seen.total() / SHARE
                return [x for x in seen.items() if x[1] >= least]
            for b in it:
                texts = column_of(b, "t")
                for t in texts:
                    seen.update(tokens(t))
                    if len(seen) > FLUSH:
                        yield from often()
                        seen.clear()
                seen[END] += len(texts)
            yield from often()
        yield from batches(rows(), schema, 20_000)

    return train.mapInArrow(count, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


class Units(dict):
    """Word -> unit; the cache of other words is emptied when it is large."""

    def __init__(self, own: dict[bytes, int]):
        super().__init__(own)
        self.own = own

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
            self.update(self.own)
        u = OWN + zlib.crc32(word[-3:]) % (UNITS - OWN)
        self[word] = u
        return u


def unit_bigrams(train: DataFrame, own: dict[bytes, int]) -> np.ndarray:
    """UNITS x UNITS counts of adjacent tokens over all training texts."""
    schema = pa.schema([("unit", pa.int32()), ("row", pa.binary())])

    def count(it):
        unit, z = Units(own), zstandard.ZstdCompressor(level=1)
        total = np.zeros(UNITS * UNITS, np.int64)
        pend, held = [], 0
        for b in it:
            for _, sizes, words in stretches(column_of(b, "t")):
                u = np.fromiter(map(unit.__getitem__, words), np.int64, len(words))
                pend.append(u[neighbours(sizes)[0]] * UNITS + u)
                held += len(u)
                if held > PENDING:
                    total += np.bincount(np.concatenate(pend), minlength=len(total))
                    pend, held = [], 0
        if pend:
            total += np.bincount(np.concatenate(pend), minlength=len(total))
        total = total.reshape(UNITS, UNITS)
        yield from batches(((i, z.compress(total[i].tobytes())) for i in np.flatnonzero(total.any(1)).tolist()), schema)

    def reduce(it):
        z, unz = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

        def rows():
            unit, total = None, None
            for b in it:
                for i, data in zip(column_of(b, "unit"), column_of(b, "row")):
                    row = np.frombuffer(unz.decompress(data), np.int64)
                    if i == unit:
                        total = total + row
                    else:
                        if unit is not None:
                            yield unit, z.compress(total.tobytes())
                        unit, total = i, row
            if unit is not None:
                yield unit, z.compress(total.tobytes())
        yield from batches(rows(), schema)

    ddl = "unit int, row binary"
    got = train.mapInArrow(count, ddl).repartition("unit").sortWithinPartitions("unit").mapInArrow(reduce, ddl)
    out, unz = np.zeros((UNITS, UNITS)), zstandard.ZstdDecompressor()
    for r in got.toLocalIterator():
        out[r["unit"]] = np.frombuffer(unz.decompress(bytes(r["row"])), np.int64)
    return out


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(pairs: np.ndarray, cls: np.ndarray, classes: int) -> float:
    """Class-bigram log likelihood, up to a term that the classes do not change."""
    one = np.eye(classes)[cls]
    n = one.T @ pairs @ one
    return float(_f(n).sum() - _f(n.sum(0)).sum() - _f(n.sum(1)).sum())


def exchange(pairs: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Class of each unit by exchange clustering of the unit bigram counts."""
    units = len(pairs)
    size = pairs.sum(1) + pairs.sum(0)
    order = np.argsort(-size, kind="stable")
    cls = np.empty(units, int)
    cls[order] = np.arange(units) % classes
    one = np.eye(classes)[cls]
    right, left = pairs @ one, pairs.T @ one       # unit -> class after it, class before it
    n = one.T @ pairs @ one
    for _ in range(passes):
        moved = 0
        for u in order:
            if not size[u]:
                continue
            own, k = pairs[u, u], cls[u]
            r, l = right[u].copy(), left[u].copy()
            r[k] -= own
            l[k] -= own
            n[k, :] -= r
            n[:, k] -= l
            n[k, k] -= own
            # Adding u to class j: row j gains r, column j gains l, the corner gains own.
            rows, cols = n + r, n + l[:, None]
            gain = (_f(rows) - _f(n)).sum(1) + (_f(cols) - _f(n)).sum(0)
            d = np.diagonal(n)
            gain += _f(d + r + l + own) - _f(d + r) - _f(d + l) + _f(d)
            nr, nc = n.sum(1), n.sum(0)
            # Class totals: what u adds to the others' totals is the same whichever class it joins.
            nr, nc = n.sum(1) + l, n.sum(0) + r
            gain -= _f(nr + r.sum() + own) - _f(nr) + _f(nc + l.sum() + own) - _f(nc)
            best = int(np.argmax(gain))
            if gain[best] <= gain[k] + 1e-9:
                best = k
            n[best, :] += r
            n[:, best] += l
            n[best, best] += own
            if best != k:
                moved += 1
                cls[u] = best
                right[:, k] -= pairs[:, u]
                right[:, best] += pairs[:, u]
                left[:, k] -= pairs[u]
                left[:, best] += pairs[u]
        if not moved:
            break
    return cls


def _frequent(counts: DataFrame, most: int) -> list:
    """At most ``most`` of the most frequent words, most frequent first: all from a least count on that is read off
    the counts' distribution on a fixed scale, so the driver gets no more than it keeps."""
    scale = F.floor(F.log2("c") * 16).cast("int")
    bins = sorted(((r["s"], r["n"]) for r in counts.groupBy(scale.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, least = 0, None
    for s, n in bins:
        total += n
        if total > most:
            break
        least = s
    if least is None:
        return []
    return sorted(counts.filter(scale >= least).collect(), key=lambda r: (-r["c"], bytes(r["word"])))


class _Numbered(dict):
    """Word -> number in order of first sight; the frequent words have the first ones."""

    def __init__(self, own: dict[bytes, int]):
        super().__init__(own)
        self.words: list[bytes] = []
        self.start = len(own)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = self.start + len(self.words)
        self.words.append(word)
        return at


def _lists(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    """Binary array whose rows are consecutive pieces of ``values``."""
    ends = np.concatenate([[0], np.cumsum(sizes) * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())])


_MET = pa.schema([("word", pa.binary()), ("k", pa.binary()), ("n", pa.binary())])


def neighbour_classes(train: DataFrame, own: dict[bytes, int], cls: np.ndarray) -> DataFrame:
    """(word, k, n) of every training word that is not in ``own``, once per task or more often: k are its neighbours' classes, those
    after it raised by CLASSES, and n how often it meets each."""

    def run(it):
        unit, number = Units(own), _Numbered(own)
        own_cls = cls[:len(own)].astype(np.int64)
        more, filled = np.empty(1024, np.int64), 0     # classes of the words numbered so far
        pend, held, keys, times = [], 0, np.empty(0, np.int64), np.empty(0, np.int64)

        def merge():
            got = np.concatenate([keys, *pend])
            uniq, at = np.unique(got, return_inverse=True)
            n = np.bincount(at, np.concatenate([times, np.ones(len(got) - len(keys), np.int64)]), len(uniq))
            return uniq, n.astype(np.int64)

        def emit():
            word, k = keys // (2 * CLASSES), keys % (2 * CLASSES)
            cuts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            names = pa.array(number.words, pa.binary()).take(pa.array(word[cuts] - number.start))
            ends = np.append(cuts, len(keys))
            for a in range(0, len(cuts), 10_000):
                b = min(a + 10_000, len(cuts))
                part, size = slice(ends[a], ends[b]), np.diff(ends[a:b + 1])
                yield pa.RecordBatch.from_arrays([names.slice(a, b - a), _lists(size, k[part].astype(np.uint8)),
                                                  _lists(size, times[part].astype(np.uint32))], schema=_MET)

        for batch in it:
            for _, sizes, words in stretches(column_of(batch, "t")):
                at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                if len(number.words) > filled:
                    if len(number.words) > len(more):
                        more = np.concatenate([more, np.empty(2 * len(number.words), np.int64)])
                    more[filled:len(number.words)] = cls[[unit[w] for w in number.words[filled:]]]
                    filled = len(number.words)
                rare = at >= len(own)
                if not rare.any():
                    continue
                c = np.where(rare, more[np.where(rare, at - len(own), 0)], own_cls[np.where(rare, 0, at)] if len(own) else 0)
                before, after = neighbours(sizes)
                at = at[rare] * (2 * CLASSES)
                pend += [at + CLASSES + c[after[rare]], at + c[before[rare]]]
                held += len(pend[-1]) + len(pend[-2])
                if held > PENDING or len(number.words) > FLUSH:
                    keys, times = merge()
                    pend, held = [], 0
                    if len(number.words) > FLUSH or len(keys) > PENDING:
                        yield from emit()
                        number, filled = _Numbered(own), 0
                        keys, times = np.empty(0, np.int64), np.empty(0, np.int64)
        keys, times = merge()
        if len(keys):
            yield from emit()

    return train.mapInArrow(run, "word binary, k binary, n binary")


def small_gains(n: np.ndarray) -> np.ndarray:
    """Row c - 1, neighbour class k: what c more meetings add in each class, c up to SMALL."""
    rows = np.concatenate([n, n.T])
    return np.stack([_f(rows + c) - _f(rows) for c in range(1, SMALL + 1)])


def best_classes(at: np.ndarray, k: np.ndarray, c: np.ndarray, cur: np.ndarray, n: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """The class of each word that raises the likelihood most, taken out of its class ``cur`` with its neighbours kept in theirs.

    Entries (word ``at``, neighbour class ``k``, ``c`` times) are sorted by word and class; ``n`` is the class bigram and
    ``table`` its ``small_gains``."""
    table = small_gains(n) if table is None else table
    words, classes = len(cur), len(n)
    after, x = k >= classes, k % classes
    met = np.zeros((2, words, classes))
    met[after.astype(int), at, x] = c
    w = cur[at]
    each = np.empty((len(at), classes))
    # Few meetings: only the cell of the word's own class differs from the table.
    few = np.flatnonzero((c <= SMALL) & (x != w))
    each[few] = table[c[few].astype(int) - 1, k[few]]
    cell = np.maximum(np.where(after[few], n[w[few], x[few]], n[x[few], w[few]]) - c[few], 0)
    each[few, w[few]] = _f(cell + c[few]) - _f(cell)
    rest = np.flatnonzero((c > SMALL) | (x == w))
    base = np.where(after[rest, None], n[:, x[rest]].T, n[x[rest]])
    base[np.arange(len(rest)), w[rest]] -= c[rest]
    own = np.flatnonzero(x[rest] == w[rest])      # the cell also holds what the word adds from its other side
    same = rest[own]
    base[own] -= met[1 - after[same].astype(int), at[same]]
    base = np.maximum(base, 0)
    each[rest] = _f(base + c[rest, None]) - _f(base)
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    gain = np.add.reduceat(each, starts, axis=0)
    for side, total in ((1, n.sum(1)), (0, n.sum(0))):
        add = met[side].sum(1)
        rest = np.repeat(total[None], words, 0)
        rest[np.arange(words), cur] -= add
        gain -= _f(rest + add[:, None]) - _f(rest)
    best, own = gain.argmax(1), np.arange(words)
    return np.where(gain[own, best] > gain[own, cur] + 1e-9, best, cur)


def exchange_rest(train: DataFrame, own: dict[bytes, int], cls: np.ndarray, n: np.ndarray) -> DataFrame:
    """(word, c, k): count and class of every training word that is not in ``own``."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("k", pa.int32())])

    def reduce(it):
        unit, table = Units(own), small_gains(n)

        def settle(names: list[bytes], at, k, c):
            key, back = np.unique(at * (2 * CLASSES) + k, return_inverse=True)
            times = np.bincount(back, c, len(key))
            at, k = key // (2 * CLASSES), key % (2 * CLASSES)
            before = np.bincount(at[k < CLASSES], times[k < CLASSES], len(names)).astype(np.int64)
            cur = cls[[unit[w] for w in names]]
            cuts = np.searchsorted(at, np.arange(len(names) + 1))
            best = np.concatenate([best_classes(at[cuts[a]:cuts[b]] - a, k[cuts[a]:cuts[b]], times[cuts[a]:cuts[b]], cur[a:b], n, table)
                                   for a in range(0, len(names), 128) for b in [min(a + 128, len(names))]])
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(before), pa.array(best, pa.int32())], schema=schema)

        none = np.empty(0, np.int64)
        last, left_k, left_n = None, none, none     # the word that the next batch may go on with, and its sums so far
        for b in it:
            names, size = [] if last is None else [last], [len(left_k)]
            ks, ns = column_of(b, "k"), column_of(b, "n")
            at = [0]
            for w in column_of(b, "word"):
                if not names or names[-1] != w:
                    names.append(w)
                at.append(len(names) - 1)
            if not names:
                continue
            at = np.repeat(at, size + list(map(len, ks)))
            k = np.concatenate([left_k, np.frombuffer(b"".join(ks), np.uint8)])
            c = np.concatenate([left_n, np.frombuffer(b"".join(ns), np.uint32)])
            end = int(np.searchsorted(at, len(names) - 1))
            last = names[-1]
            left_k, back = np.unique(k[end:], return_inverse=True)
            left_n = np.bincount(back, c[end:], len(left_k)).astype(np.int64)
            if len(names) > 1:
                yield settle(names[:-1], at[:end], k[:end], c[:end])
        if last is not None:
            yield settle([last], np.zeros(len(left_k), np.int64), left_k, left_n)

    met = neighbour_classes(train, own, cls).repartition("word").sortWithinPartitions("word")
    return met.mapInArrow(reduce, "word binary, c bigint, k int")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: packed, and lineage ends here."""
    path = f"{checkpoint_dir(df.sparkSession)}/class-lm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@dataclass
class Lexicon:
    own: dict[bytes, int]                     # frequent word -> unit
    cls: np.ndarray                           # unit -> class
    known: dict[bytes, tuple[int, int]]       # most frequent words -> count and class
    table: DataFrame                          # (word, c, k) of every training word, written
    n: int
    v: int


def learn(train: DataFrame) -> Lexicon:
    """Counts and classes of all words of the training texts (column t)."""
    counts = cut(frequent_counts(train))
    own = {bytes(r["word"]): i for i, r in enumerate(_frequent(counts, max(OWN, KNOWN))[:OWN])}
    pairs = unit_bigrams(train, own)
    cls = exchange(pairs, CLASSES, PASSES)
    one = np.eye(CLASSES)[cls]
    rest = exchange_rest(train, own, cls, one.T @ pairs @ one)
    times = pairs.sum(0)
    first = counts.sparkSession.createDataFrame([(w, int(times[u]), int(cls[u])) for w, u in own.items()], "word binary, c bigint, k int")
    table = _stored(rest.unionAll(first), "lexicon")
    known = {bytes(r["word"]): (r["c"], r["k"]) for r in _frequent(table, KNOWN)}
    return Lexicon(own, cls, known, table, int(pairs.sum()), table.count())


@dataclass
class Pairs:
    """The adjacent tokens of all documents by class."""
    docs: DataFrame         # uid, held, doc: pairs of known words (k pairs of classes, m times) and what these settle
    rare: DataFrame         # uid, held, i class and c count of a rarer word, l and r classes of known neighbours or -1, n times
    between: DataFrame      # uid, held, l and i classes of two rarer words side by side, n times


_DOC = pa.struct([("id", pa.int64()), ("k", pa.binary()), ("m", pa.binary()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                  ("base", pa.float64()), ("score", pa.float64())])
_ROWS = pa.schema([("uid", pa.int64()), ("held", pa.bool_()), ("word", pa.binary()), ("prev", pa.binary()), ("i", pa.int32()),
                   ("l", pa.int32()), ("r", pa.int32()), ("n", pa.int64()), ("doc", _DOC)])


def class_pairs(rows: DataFrame, lex: Lexicon) -> Pairs:
    """The adjacent tokens of every row (columns uid, id, held, t) by class; all texts are read once."""
    norm = math.log10(lex.n + lex.v + 1)
    own, units, known = lex.own, lex.cls, lex.known

    def run(it):
        unit = Units(own)
        place = {w: i for i, w in enumerate(known)}
        c = np.array([c for c, _ in known.values()], float)
        cls_of = np.append(np.array([k for _, k in known.values()], np.int64), -1)     # -1: not known
        base_of, emit_of = np.log10(c + 1) - norm, np.log10(c + DELTA)
        side = CLASSES + 1

        def rows_of(size: int, uid, held, /, **given):
            """Rows with the given columns; the others hold nothing."""
            none = {"prev": None, "i": 0, "l": -1, "r": -1, "n": 0, "doc": None}
            got = {"uid": uid, "held": held} | given
            cols = [got[f.name] if f.name in got else pa.nulls(size, f.type) if none[f.name] is None else pa.array(np.full(size, none[f.name]), f.type)
                    for f in _ROWS]
            whole = pa.RecordBatch.from_arrays(cols, schema=_ROWS)
            for a in range(0, size, 20_000):
                yield whole.slice(a, 20_000)

        for b in it:
            column = {x: b.column(b.schema.get_field_index(x)) for x in ("uid", "id", "held")}
            for first, sizes, words in stretches(column_of(b, "t")):
                docs = len(sizes)
                uid, ids, held = (column[x].slice(first, docs) for x in ("uid", "id", "held"))
                at = np.fromiter(map(place.get, words, repeat(-1)), np.int64, len(words))
                cls, hit, doc = cls_of[at], at >= 0, np.repeat(np.arange(docs), sizes)
                before, after = neighbours(sizes)
                left = cls[before]
                both = hit & (left >= 0)
                key, m = np.unique((doc[both] * CLASSES + left[both]) * CLASSES + cls[both], return_counts=True)
                size = np.bincount(key // CLASSES ** 2, minlength=docs)
                got, of = at[hit], doc[hit]
                # The row of the document itself has a word that no text holds, of its own.
                yield from rows_of(docs, uid, held, word=pa.array([b"\n%d" % u for u in uid.to_pylist()], pa.binary()), doc=pa.StructArray.from_arrays(
                    [ids, _lists(size, (key % CLASSES ** 2).astype(np.uint16)), _lists(size, m.astype(np.uint32)), pa.array(sizes, pa.int64()),
                     pa.array(np.bincount(of, minlength=docs), pa.int64()), pa.array(np.bincount(of, base_of[got], docs), pa.float64()),
                     pa.array(np.bincount(of, emit_of[got], docs), pa.float64())], fields=list(_DOC)))
                miss = np.flatnonzero(~hit)
                if not len(miss):
                    continue
                number = _Numbered({})
                rare = np.full(len(words), -1)
                rare[miss] = np.fromiter(map(number.__getitem__, map(words.__getitem__, miss.tolist())), np.int64, len(miss))
                names, own_cls = pa.array(number.words, pa.binary()), units[[unit[w] for w in number.words]]
                many = len(number.words)
                # The unit's class stands unless the lexicon has the word.
                key, n = np.unique(((doc[miss] * many + rare[miss]) * side + left[miss] + 1) * side + cls[after[miss]] + 1, return_counts=True)
                of, w = np.divmod(key // side ** 2, many)
                yield from rows_of(len(key), uid.take(pa.array(of)), held.take(pa.array(of)), word=names.take(pa.array(w)), i=pa.array(own_cls[w], pa.int32()),
                                   l=pa.array(key // side % side - 1, pa.int32()), r=pa.array(key % side - 1, pa.int32()), n=pa.array(n, pa.int64()))
                two = miss[left[miss] < 0]
                if not len(two):
                    continue
                key, n = np.unique((doc[two] * many + rare[two]) * many + rare[before[two]], return_counts=True)
                of, w, p = key // many ** 2, key // many % many, key % many
                yield from rows_of(len(key), uid.take(pa.array(of)), held.take(pa.array(of)), word=names.take(pa.array(w)), prev=names.take(pa.array(p)),
                                   i=pa.array(own_cls[w], pa.int32()), l=pa.array(own_cls[p], pa.int32()), n=pa.array(n, pa.int64()))

    ddl = ("uid bigint, held boolean, word binary, prev binary, i int, l int, r int, n bigint, doc struct<id:bigint,k:binary,m:binary,"
           "n_tokens:bigint,n_known:bigint,base:double,score:double>")
    met = _stored(rows.mapInArrow(run, ddl).join(lex.table, "word", "left")
                  .select("uid", "held", "prev", F.coalesce("k", "i").alias("i"), "l", "r", "n", F.coalesce("c", F.lit(0)).alias("c"), "doc"), "met")
    first = lex.table.select(F.col("word").alias("prev"), "k")
    between = _stored(met.filter("prev is not null").select("uid", "held", "prev", "i", "l", "n").join(first, "prev", "left")
                      .select("uid", "held", "i", F.coalesce("k", "l").alias("l"), "n"), "between")
    return Pairs(met.filter("doc is not null").select("uid", "held", "doc"),
                 met.filter("doc is null and prev is null").select("uid", "held", "i", "c", "l", "r", "n"), between)


def _known_pairs(b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair of classes and times of the known pairs in a batch of documents (columns k, m)."""
    k, m = column_of(b, "k"), column_of(b, "m")
    size = np.fromiter(map(len, k), np.int64, len(k)) // 2
    return (np.repeat(np.arange(len(k)), size), np.frombuffer(b"".join(k), np.uint16).astype(np.int64),
            np.frombuffer(b"".join(m), np.uint32).astype(np.int64))


def class_bigram(pairs: Pairs) -> np.ndarray:
    """How often class follows class in the rows that are not held out."""
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])

    def tally(it):
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for b in it:
            _, key, n = _known_pairs(b)
            total += np.bincount(key, n, len(total)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at // CLASSES, pa.int32()), pa.array(at % CLASSES, pa.int32()), pa.array(total[at])],
                                         schema=schema)

    known = pairs.docs.filter("not held").select("doc.k", "doc.m").mapInArrow(tally, "a int, b int, n bigint")
    rare = pairs.rare.filter("not held").groupBy("l", "i", "r").agg(F.sum("n").alias("n"))
    rare = rare.select(F.explode(F.array(F.struct(F.col("l").alias("a"), F.col("i").alias("b"), "n"),
                                         F.struct(F.col("i").alias("a"), F.col("r").alias("b"), "n"))).alias("x")).select("x.*").filter("a >= 0 and b >= 0")
    both = pairs.between.filter("not held").select(F.col("l").alias("a"), F.col("i").alias("b"), "n")
    out = np.zeros((CLASSES, CLASSES))
    for r in known.unionAll(rare).unionAll(both).groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        out[r["a"], r["b"]] = r["n"]
    return out


@dataclass
class Model:
    transition: np.ndarray        # log10 P(c2 | c1)
    tokens: np.ndarray            # class -> training tokens
    types: np.ndarray             # class -> distinct training words


def model_of(n: np.ndarray, table: DataFrame) -> Model:
    """The model of the class bigram ``n`` and the lexicon's table."""
    after = n.sum(1, keepdims=True)
    back = (n.sum(0) + DELTA) / (n.sum() + DELTA * CLASSES)
    p = np.where(after > 0, KEEP * n / np.maximum(after, 1) + (1 - KEEP) * back, back)
    types = np.zeros(CLASSES)
    for r in table.groupBy("k").agg(F.count(F.lit(1)).alias("v")).collect():
        types[r["k"]] = r["v"]
    return Model(np.log10(p), n.sum(0), types)


def score(pairs: Pairs, model: Model, lex: Lexicon) -> DataFrame:
    """uid, id, held, n_tokens, n_known, base, score of every document."""
    schema = pa.schema([("uid", pa.int64()), ("path", pa.float64())])
    step = (model.transition - np.log10(model.tokens + DELTA * (model.types + 1))).ravel()
    norm = math.log10(lex.n + lex.v + 1)

    def run(it):
        for b in it:
            row, key, n = _known_pairs(b)
            path = np.bincount(row, n * step[key], b.num_rows) + np.array(column_of(b, "score"), float)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(path)], schema=schema)

    steps = F.split(F.lit(",".join(map(repr, step.tolist()))), ",").cast("array<double>")     # folded into one constant

    def taken(a: Column, b: Column) -> Column:
        return F.when((a >= 0) & (b >= 0), steps[a * CLASSES + b]).otherwise(0.0)
    i, l, r, c, n = (F.col(x) for x in ("i", "l", "r", "c", "n"))
    zero, nothing = F.lit(0).cast("bigint"), F.lit(0.0)
    known = pairs.docs.select("uid", "doc.k", "doc.m", "doc.score").mapInArrow(run, "uid bigint, path double")
    parts = (pairs.rare.select("uid", F.when(c > 0, n).otherwise(zero).alias("n_known"), (n * (F.log10(c + 1.0) - F.lit(norm))).alias("base"),
                               (n * (F.log10(c + DELTA) + taken(l, i) + taken(i, r))).alias("score"))
             .unionAll(pairs.between.select("uid", zero, nothing, n * taken(l, i)))
             .unionAll(known.select("uid", zero, nothing, "path"))
             .unionAll(pairs.docs.select("uid", "doc.n_known", "doc.base", nothing)))
    sums = parts.groupBy("uid").agg(*[F.sum(x).alias(x) for x in ("n_known", "base", "score")])
    return pairs.docs.select("uid", "doc.id", "held", "doc.n_tokens").join(sums, "uid")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows that are not held out and score all."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("bigint").alias("id"),
                       held_out(F.col(id_col)).alias("held"), text_bytes(text_col).alias("t"))
    lex = learn(rows.filter(~F.col("held")).select("t"))
    pairs = class_pairs(rows, lex)
    model = model_of(class_bigram(pairs), lex.table)
    return score(pairs, model, lex).withColumn("train_tokens", F.lit(lex.n).cast("bigint"))
