"""Centroid clustering (Lloyd's rounds) with ns-bounds: the history of all centroids is kept, and a distance that was measured
rounds ago is loosened by the norm of the centroid's whole way since then, not by the sum of its steps. What the bounds
cannot settle is measured again exactly.

Vectors become whole numbers, floor(scale * x). A vector's state is, for every centroid, the distance last measured
and the round of that measurement. In round t the distance to centroid j is at least the measured one less
|C_t[j] - C_s[j]| (s: its round), and to the vector's own centroid at most the measured one plus that norm. If every other
lower bound is above the upper bound, the vector stays and nothing is measured. Else its own distance is measured, and then,
if still needed, the centroids whose bounds fail. Squared distances are whole numbers, compared exactly, ties to the
smaller number; bounds are doubles with a margin wider than their rounding, so every assignment equals the full search.

Layout: vectors and states are rows of one table, written once a round to the shared checkpoint folder, so a
lost executor costs at most the current round; a round is one pass without shuffle followed by a sum per cluster and
component that is reduced inside each task first (a cluster with a third of all rows sends k rows per task like any
other). The driver holds the history only: rounds x k x dim numbers, which also bounds what tasks receive. A state is
k doubles and k small numbers beside dim whole numbers.

Defined results: a vector that is null, has another number of components or holds a null or non-finite one takes no part, nor
does one whose scaled components reach 2^27 (their squared distances would not fit a long). Rows with the same id
are separate vectors; at the start ids' hashes order them, equal ones by their vectors, rows without id last. With fewer than k
vectors there are fewer centroids; an empty cluster keeps its centroid; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import cut

K = 16
DIM = 64
ROUNDS = 3
SCALE = 64
LIMIT = 1 << 27
MARGIN = 1e-9        # relative; doubles round at 1e-16

_OUT = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.int32())), ("a", pa.int32()), ("d", pa.int64()), ("n", pa.int64()),
                  ("low", pa.list_(pa.float64())), ("at", pa.list_(pa.int8()))])
_DDL = "id bigint, v array<int>, a int, d bigint, n bigint, low array<double>, at array<tinyint>"


def kept_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id and v (whole numbers) of the vectors that take part."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < LIMIT) & ~F.isnan(x))
    d = vectors.filter(v.isNotNull() & (F.size(v) == dim)).filter(finite)
    return d.select(F.col(id_col).cast("bigint").alias("id"),
                    F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("int")).alias("v"))


def first_centroids(rows: DataFrame, k: int = K) -> np.ndarray:
    """The vectors with the k smallest hashes of their ids, in that order."""
    h = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(h.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in first], np.int64)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x to rows of c, pair by pair."""
    diff = x - c
    return np.einsum("ij,ij->i", diff, diff)


def first_state(x: np.ndarray, c: np.ndarray):
    """Everything measured: assignment, squared distance, measured distances and their rounds."""
    n, k = len(x), len(c)
    sq = np.empty((n, k), np.int64)
    for j in range(k):
        sq[:, j] = distances(x, c[j][None])
    a = sq.argmin(1)                                     # ties: the smaller number
    return a, sq[np.arange(n), a], np.full(n, k), np.sqrt(sq.astype(np.float64)), np.zeros((n, k), np.int8)


def next_state(x: np.ndarray, a: np.ndarray, low: np.ndarray, at: np.ndarray, history: list[np.ndarray]):
    """One round: the state under the newest centroids, with the number of distances measured per vector. ``low`` holds the
    distances last measured and ``at`` their rounds; both are changed."""
    now, t = history[-1], len(history) - 1
    n, k = low.shape
    rows = np.arange(n)
    ways = np.stack([np.sqrt(((now - then).astype(np.float64) ** 2).sum(1)) for then in history])   # round x centroid
    way = ways[at, np.arange(k)]
    under = (low - way) - MARGIN * (1 + low + way)
    over = low[rows, a] + way[rows, a]
    over += MARGIN * (1 + over)
    measured = np.zeros(n, np.int64)
    open_ = under <= over[:, None]
    open_[rows, a] = False
    todo = np.flatnonzero(open_.any(1))
    best = np.full(n, -1, np.int64)
    new = a.copy()
    if len(todo):
        own = distances(x[todo], now[a[todo]])
        best[todo] = own
        low[todo, a[todo]], at[todo, a[todo]] = np.sqrt(own.astype(np.float64)), t
        measured[todo] += 1
        exact = np.sqrt(own.astype(np.float64))
        still = open_[todo] & (under[todo] <= (exact + MARGIN * (1 + exact))[:, None])
        i, j = np.nonzero(still)
        i = todo[i]
        if len(i):
            sq = distances(x[i], now[j])
            low[i, j], at[i, j] = np.sqrt(sq.astype(np.float64)), t
            np.add.at(measured, i, 1)
            # Smallest (distance, number) per vector, its own centroid included.
            every = np.concatenate([todo, i]), np.concatenate([own, sq]), np.concatenate([a[todo], j])
            order = np.lexsort((every[2], every[1], every[0]))
            who = every[0][order]
            lead = np.concatenate([[True], who[1:] != who[:-1]])
            new[who[lead]], best[who[lead]] = every[2][order][lead], every[1][order][lead]
    return new, best, measured, low, at


def _matrix(column: pa.ChunkedArray | pa.Array, width: int, kind) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _as_lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.ravel(), kind))


def _step(rows: DataFrame, history: list[np.ndarray], dim: int) -> DataFrame:
    k = len(history[0])

    def run(it):
        for b in it:
            if not b.num_rows:
                continue
            col = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            x = _matrix(col["v"], dim, np.int64)
            if len(history) == 1:
                a, best, measured, low, at = first_state(x, history[0])
            else:
                a, best, measured, low, at = next_state(x, col["a"].to_numpy().astype(np.int64), _matrix(col["low"], k, np.float64),
                                                        _matrix(col["at"], k, np.int8), history)
                measured += col["n"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [col["id"].cast(pa.int64()), _as_lists(x, pa.int32()), pa.array(a, pa.int32()), pa.array(best, pa.int64()),
                 pa.array(measured, pa.int64()), _as_lists(low, pa.float64()), _as_lists(at, pa.int8())], schema=_OUT)
    return rows.mapInArrow(run, _DDL)


def _means(state: DataFrame, c: np.ndarray) -> np.ndarray:
    """The clusters' componentwise floor(sum / count); an empty cluster's old centroid."""
    dim = c.shape[1]
    sums = state.groupBy("a").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i].cast("bigint")).alias(f"s{i}") for i in range(dim)])
    out = c.copy()
    for r in sums.collect():                             # k rows
        out[r["a"]] = [r[f"s{i}"] // r["n"] for i in range(dim)]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, id_col: str = "vec_id",
            vec_col: str = "embedding", centroids: np.ndarray | None = None) -> tuple[DataFrame, list[np.ndarray]]:
    """The clustered vectors (id, cluster, distance: squared, n_measured: distances measured for it in all rounds), and the history
    of centroids. ``rounds`` below 127."""
    rows = cut(kept_vectors(vectors, dim, scale, id_col, vec_col))
    history = [first_centroids(rows, k) if centroids is None else np.asarray(centroids, np.int64)]
    if not len(history[0]):
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"),
                           F.lit(0).cast("bigint").alias("n_measured")).filter("false"), history
    state = rows
    for _ in range(rounds):
        state = cut(_step(state, history, dim))
        history.append(_means(state, history[-1]))
    last = _exact(_step(state, history, dim), history[-1], dim)
    return last, history


def _exact(state: DataFrame, c: np.ndarray, dim: int) -> DataFrame:
    """The final rows: vectors that the bounds settled have their own distance measured now."""
    out = pa.schema([("id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("n_measured", pa.int64())])

    def run(it):
        for b in it:
            if not b.num_rows:
                continue
            col = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            a, best, n = (col[x].to_numpy().astype(np.int64) for x in ("a", "d", "n"))
            left = np.flatnonzero(best < 0)
            best = best.copy()
            best[left] = distances(_matrix(col["v"], dim, np.int64)[left], c[a[left]])
            yield pa.RecordBatch.from_arrays([col["id"].cast(pa.int64()), pa.array(a, pa.int32()), pa.array(best, pa.int64()),
                                              pa.array(n + (col["d"].to_numpy() < 0), pa.int64())], schema=out)
    return state.mapInArrow(run, "id bigint, cluster int, distance bigint, n_measured bigint")


def digest(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The contract's columns from ``cluster``."""
    found = cut(found)
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()      # k rows
    total = sum(r["cluster_inertia"] for r in sums)
    rows = [(r["cluster"], r["cluster_inertia"], total, hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest())
            for r in sums]
    facts = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return (found.join(F.broadcast(facts), "cluster")
            .select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
