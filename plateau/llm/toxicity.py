"""Toxicity by a classifier chain: the categories are predicted one after another, and every
later linear model sees the probabilities of the earlier ones.

While the chain is trained those probabilities are out of fold: each training row gets them from
a model that has not seen it, so a later model learns how far it can trust them. A category's
model is a logistic regression (Newton steps, L2) over the presence of words picked by the
root of their G statistic within the training fold, eight clipped shape features of the whole
text, and the logits of the earlier categories. The decision threshold is the one with the best
out-of-fold F1.

Only the fit is bounded: it uses at most ``SAMPLE`` labelled rows (those with the smallest
seeded hash of the id). Scoring reads every row and the whole text of each.

Defined results: null text is empty; labels that are null are not used; a label id that repeats
counts once with its largest value, and so does an id that several documents share, with the
least of their texts; with no labelled rows or a single class the probability is
the base rate (0 without labels) and nothing is rejected; columns of the documents pass through
``keep_clean`` unchanged, null ids and repeated rows included; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import batches, column_of, seeded_sample, text_bytes

SAMPLE = 8_000      # labelled rows the fit may use, at most
WORDS = 256         # word features a category may use, at most
Z_MIN = 4.0         # least z of a word feature
FOLDS = 4
SHAPES = 8          # shape features of a text
L2, L2_SHAPE = 1.0, 10.0
CLIP = 3.0          # standard deviations a shape feature can be away from the sample's mean


def label_categories() -> dict[str, Column]:
    """The categories that the labels hold, in chain order."""
    return {"low_quality": (F.col("quality") == 0).cast("int"), "toxic": (F.col("toxic") != 0).cast("int")}


# ASCII letters lowered, digits and bytes of other alphabets kept, the rest to spaces.
_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else (b if b >= 128 else 32) for b in range(256))
_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))
_PUNCT = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def features(t: bytes) -> tuple[np.ndarray, list[float]]:
    """Sorted CRC-32 of the distinct words, and the shape of the whole text."""
    words = t.translate(_FOLD).split()
    seen = set(words)
    w = np.fromiter(map(zlib.crc32, seen), np.uint32, len(seen))
    n, k = len(t) + 1, len(words) + 1

    def share(chars: bytes) -> float:
        return (len(t) - len(t.translate(None, chars))) / n
    lines = t.split(b"\n")
    shape = [float(np.log(k)), len(seen) / k, (n - 1) / k / 10, 10 * share(_UPPER), 10 * share(_DIGIT), 10 * share(_PUNCT),
             len(set(lines)) / len(lines), float(np.log(n / len(lines)))]
    return np.sort(w), shape


@dataclass
class Link:
    """One category's linear model."""
    name: str
    words: np.ndarray
    weights: np.ndarray          # words, shape, earlier logits, bias
    center: np.ndarray
    scale: np.ndarray
    threshold: float = 0.5

    def logit(self, words: np.ndarray, shape: list[float], earlier: list[float]) -> float:
        m = len(self.words)
        at = np.searchsorted(self.words, words)
        at[at == m] = 0
        hit = at[self.words[at] == words] if m else at[:0]
        dense = np.clip((np.concatenate([shape, earlier]) - self.center) / self.scale, -CLIP, CLIP)
        return float(self.weights[hit].sum() + dense @ self.weights[m:-1] + self.weights[-1])


@dataclass
class Chain:
    links: list[Link] = field(default_factory=list)

    def predict(self, t: bytes) -> list[float]:
        words, shape = features(t)
        logits: list[float] = []
        for link in self.links:
            logits.append(min(30.0, max(-30.0, link.logit(words, shape, logits))))
        return [float(1 / (1 + np.exp(-x))) for x in logits]


def _pick(words: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    ids, where = np.unique(np.concatenate(words) if words else np.empty(0, np.uint32), return_inverse=True)
    if not len(ids):
        return ids
    label = np.repeat(y, [len(w) for w in words])
    pos = np.bincount(where, weights=label, minlength=len(ids))
    neg = np.bincount(where, minlength=len(ids)) - pos
    rate = y.sum() / len(y)
    df = pos + neg

    def part(seen, expected):
        return seen * np.log(np.maximum(seen, 1e-9) / expected)
    # Root of the G statistic of (word present, class): a z-score for small counts too.
    z = np.sqrt(np.maximum(0, 2 * (
        part(pos, df * rate) + part(neg, df * (1 - rate)) + part(y.sum() - pos, (len(y) - df) * rate + 1e-9)
        + part(len(y) - y.sum() - neg, (len(y) - df) * (1 - rate) + 1e-9))))
    order = np.lexsort((ids, -z))[:WORDS]
    return np.sort(ids[order[z[order] >= Z_MIN]])


def _matrix(words: list[np.ndarray], dense: np.ndarray, vocab: np.ndarray) -> np.ndarray:
    x = np.zeros((len(words), len(vocab) + dense.shape[1] + 1))
    for i, w in enumerate(words):
        if len(vocab):
            at = np.searchsorted(vocab, w)
            at[at == len(vocab)] = 0
            x[i, at[vocab[at] == w]] = 1
    x[:, len(vocab):-1] = dense
    x[:, -1] = 1
    return x


def _train(name: str, words: list[np.ndarray], dense: np.ndarray, y: np.ndarray) -> Link:
    d = dense.shape[1]
    center, scale = (dense.mean(0), dense.std(0) + 1e-9) if len(dense) else (np.zeros(d), np.ones(d))
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.0
        bias = -30.0 if rate == 0 else 30.0
        return Link(name, np.empty(0, np.uint32), np.r_[np.zeros(d), bias], center, scale)
    vocab = _pick(words, y)
    x = _matrix(words, np.clip((dense - center) / scale, -CLIP, CLIP), vocab)
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], L2)
    ridge[len(vocab):len(vocab) + SHAPES], ridge[-1] = L2_SHAPE, 1e-6
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge), g)
        w -= step * min(1.0, 8.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return Link(name, vocab, w, center, scale)


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Threshold of the best F1, in the middle of the gap it falls in."""
    if not len(y) or y.min() == y.max():
        return 1.1  # nothing is rejected
    order = np.argsort(-p, kind="stable")
    s, hit = p[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(np.argmax(f1))
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0)) / 2)


def fit_rows(words: list[np.ndarray], shapes: np.ndarray, labels: dict[str, np.ndarray]) -> Chain:
    """Train the chain in the order of ``labels``; the rows are the bounded sample."""
    chain, dense = Chain(), shapes
    fold = np.arange(len(words)) % FOLDS
    for name, y in labels.items():
        link = _train(name, words, dense, y)
        oof = np.zeros(len(y))
        for f in range(FOLDS):
            rest, out = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            part = _train(name, [words[i] for i in rest], dense[rest], y[rest])
            for i in out:
                oof[i] = min(30.0, max(-30.0, part.logit(words[i], dense[i][:shapes.shape[1]], dense[i][shapes.shape[1]:])))
        link.threshold = _best_threshold(1 / (1 + np.exp(-oof)), y)
        chain.links.append(link)
        dense = np.column_stack([dense, oof])
    return chain


def fit(documents: DataFrame, labels: DataFrame, categories: dict[str, Column] | None = None,
        id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, seed: int = 0) -> Chain:
    """The chain over ``categories`` (name -> 0/1 expression over the labels, in chain order)."""
    categories = categories or label_categories()
    names = list(categories)
    known = labels.select(F.col(id_col).cast("bigint").alias("_id"),
                          *[c.cast("int").alias(f"_y{i}") for i, c in enumerate(categories.values())]).dropna()
    known = known.groupBy("_id").agg(*[F.max(f"_y{i}").alias(f"_y{i}") for i in range(len(names))])
    known = seeded_sample(known, sample, ["_id"], seed)
    texts = documents.select(F.col(id_col).cast("bigint").alias("_id"), text_bytes(text_col).alias("_t"))
    # At most ``sample`` ids are broadcast, and of the documents with one id the one with the least text is fitted on.
    rows = texts.join(F.broadcast(known), "_id").groupBy(*known.columns).agg(F.min("_t").alias("_t"))
    schema = pa.schema([("id", pa.int64()), *[(f"y{i}", pa.int32()) for i in range(len(names))],
                        ("w", pa.binary()), ("s", pa.binary())])
    ddl = "id bigint, " + "".join(f"y{i} int, " for i in range(len(names))) + "w binary, s binary"

    def extract(it):
        def out():
            for b in it:
                ys = [column_of(b, f"_y{i}") for i in range(len(names))]
                for i, t, *y in zip(column_of(b, "_id"), column_of(b, "_t"), *ys):
                    w, s = features(t)
                    yield (i, *y, w.tobytes(), np.array(s).tobytes())
        yield from batches(out(), schema)

    got = rows.mapInArrow(extract, ddl).toArrow().to_pylist()
    got.sort(key=lambda r: (zlib.crc32(str(r["id"]).encode()), r["id"], r["w"]))
    words = [np.frombuffer(r["w"], np.uint32) for r in got]
    shapes = np.array([np.frombuffer(r["s"]) for r in got]).reshape(len(got), SHAPES)
    return fit_rows(words, shapes, {n: np.array([r[f"y{i}"] for r in got], float) for i, n in enumerate(names)})


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, one probability per category, and whether the last category rejects the document."""
    names = [link.name for link in chain.links]
    schema = pa.schema([("id", pa.int64()), *[(f"p_{n}", pa.float64()) for n in names], ("rejected", pa.bool_())])
    ddl = "id bigint, " + "".join(f"p_{n} double, " for n in names) + "rejected boolean"
    limit = chain.links[-1].threshold

    def run(it):
        def out():
            for b in it:
                for i, t in zip(column_of(b, "id"), column_of(b, "t")):
                    p = chain.predict(t)
                    yield (i, *p, p[-1] >= limit)
        yield from batches(out(), schema)

    return (docs.select(F.col(id_col).cast("bigint").alias("id"), text_bytes(text_col).alias("t"))
            .mapInArrow(run, ddl))


def keep_clean(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that the last category of the chain does not reject."""
    limit, at = chain.links[-1].threshold, docs.columns.index(text_col)

    def run(it):
        for b in it:
            texts = b.column(at).to_pylist()
            yield b.filter(pa.array([chain.predict((t or "").encode())[-1] < limit for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
