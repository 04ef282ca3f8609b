"""Approximate nearest neighbours by collision-counting hashing with query-centred windows.

Every vector is projected on ``PROJECTIONS`` random directions; per direction the values form a
sorted array. A query looks at the window around its own projection in every array; a
vector that lies in at least ``THRESHOLD`` of them collides often enough to be a candidate.
While there are too few candidates the windows widen by ``GROWTH`` (virtual rehashing: the same
arrays serve every radius), up to the whole array, so the search always ends with enough
candidates or with all vectors. Candidates are verified by their exact Euclidean distance
in double precision on the original vectors.

Layout: the distinct vectors (with the k + 1 smallest ids that carry each, which is all that k
nearest with ties to smaller ids can need) are dealt by hash into blocks, the queries into
chunks. A (block, chunk) cell is one task that builds its arrays and emits k rows per
query; the k best over the blocks are taken by a window that trims before the shuffle. No
task holds more than a block, and copies of one vector cost one row, however many there are.

Defined results: a vector that is null, zero, or holds a null or non-finite component takes no
part, as query or candidate, nor does a row without id; an id is one row, its smallest
vector if it repeats; vectors of another length than the query are no candidates; fewer than k
candidates are all returned; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateau.llm.common import cut

PROJECTIONS = 96
THRESHOLD = 72
START = 0.5          # first half-width of a window, in mean absolute deviations of the projections
GROWTH = 1.1
CANDIDATES = 0.15    # share of a block that must be candidates before the windows stop growing
BLOCK = 16_384       # distinct vectors in a block, about
CHUNK = 1_024        # queries in a chunk, about


def valid(vec: str) -> Column:
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges [start, stop), one after another."""
    size = np.maximum(stop - start, 0)
    ends = np.cumsum(size)
    return np.arange(ends[-1]) + np.repeat(start - (ends - size), size)


def search_block(base: np.ndarray, queries: np.ndarray, k: int, seed: int = 0):
    """Yield (query number, candidate rows of ``base``, their exact distances), in any order."""
    n, dim = base.shape
    a = np.random.default_rng([seed, dim]).standard_normal((dim, PROJECTIONS))
    proj, qproj = base.astype(np.float64) @ a, queries.astype(np.float64) @ a
    order = np.argsort(proj, axis=0, kind="stable").T.copy()
    values = np.take_along_axis(proj.T, order, 1)
    order, offset = order.ravel(), np.arange(PROJECTIONS) * n
    half = START * (float(np.abs(proj - np.median(proj, 0)).mean()) + 1e-12)
    enough = min(n, k + int(np.ceil(CANDIDATES * n)))
    exact, exact_q = base.astype(np.float64), queries.astype(np.float64)
    # A query's window in array j is [lo, hi); it starts empty at the query's own place.
    lo = np.stack([np.searchsorted(values[j], qproj[:, j]) for j in range(PROJECTIONS)], 1)
    hi, active = lo.copy(), np.arange(len(queries))
    counts = np.zeros((len(queries), n), np.uint8 if PROJECTIONS < 256 else np.uint16)
    while len(active):
        new_lo = np.stack([np.searchsorted(values[j], qproj[active, j] - half, "left") for j in range(PROJECTIONS)], 1)
        new_hi = np.stack([np.searchsorted(values[j], qproj[active, j] + half, "right") for j in range(PROJECTIONS)], 1)
        going = []
        for i, l, h in zip(active, new_lo, new_hi):
            grown = np.concatenate([_ranges(offset + l, offset + lo[i]), _ranges(offset + hi[i], offset + h)])
            counts[i] += np.bincount(order[grown], minlength=n).astype(counts.dtype)
            lo[i], hi[i] = l, h
            cand = np.flatnonzero(counts[i] >= THRESHOLD)
            if len(cand) < enough and (l.any() or (h < n).any()):
                going.append(i)
                continue
            diff = exact[cand] - exact_q[i]
            yield i, cand, np.sqrt(np.einsum("ij,ij->i", diff, diff))
        active = np.array(going, int)
        half *= GROWTH


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            seed: int = 0, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row."""
    rows = (vectors.withColumn("_q", F.coalesce(is_query, F.lit(False)))
            .select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v"), "_q")
            .filter(F.col("id").isNotNull() & valid("v")))
    rows = cut(rows.groupBy("id").agg(F.min(F.struct("v", "_q")).alias("r")).select("id", "r.v", F.col("r._q").alias("q")))
    ids = rows.withColumn("rn", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("rn") <= k + 1)
    # At most k + 1 ids each: the longest list this can make.
    base = cut(ids.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    queries = rows.filter("q").select("id", "v")
    n_blocks = max(1, -(-base.count() // block))
    n_chunks = max(1, -(-queries.count() // chunk))
    dim = F.size("v").alias("dim")
    left = base.select(dim, F.pmod(F.xxhash64("v"), F.lit(n_blocks)).cast("int").alias("b"),
                       F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("c"), "ids", "v")
    right = queries.select(dim, F.pmod(F.xxhash64("id"), F.lit(n_chunks)).cast("int").alias("c"),
                           F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("b"), "id", "v")

    def cell(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(x) and len(q):
            own, ids = q["id"].to_numpy(), x["ids"].tolist()
            for i, cand, dist in search_block(np.stack(x["v"]), np.stack(q["v"]), k + 1, seed):
                me = int(own[i])
                # The k + 1 nearest distinct vectors and all that tie with the last hold the k best.
                near = cand[dist <= np.partition(dist, k)[k]] if len(cand) > k + 1 else cand
                at = dict(zip(cand.tolist(), dist.tolist()))
                best = sorted((at[i], v) for i in near.tolist() for v in ids[i] if v != me)[:k]
                out += [(me, v, d) for d, v in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = (left.groupBy("dim", "b", "c").cogroup(right.groupBy("dim", "b", "c"))
             .applyInPandas(cell, "query_id bigint, vec_id bigint, score double"))
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
