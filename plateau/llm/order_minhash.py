"""Near-dedup by Order MinHash: several minimum occurrence-labelled k-mers, kept in text order.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered. A text's k-mers are its runs of five words, each
labelled by how often it has occurred before; in each of ``TABLES`` hash orders the ``PICKS`` least ones are
taken and listed in the order of the text, so two texts agree in a table only if they share these
k-mers in the same order. Two texts whose k-mers overlap by J agree in a table with a probability of about
J**PICKS: at 0.8 a pair of long texts is missed by all tables with probability (1 - 0.8**4)**24 = 3e-6, one of 10
k-mers together with 6e-5. Texts of at most ``SHORT`` distinct k-mers also have keys for the set of these and
for the set without each one: two that together have no more than that always meet.

Equal word sequences are one node. Nodes that agree in a table are a bucket. A bucket does not emit its
pairs. First every node is paired with one hub: over all its buckets the node that meets most others, the
likely original of a family. The pairs are verified and linked nodes become components; a bucket that is
one component is done. The nodes of all other buckets, whatever their size, are joined exactly: every pair of different
components whose shingle sets have a Jaccard similarity of ``SIMILARITY`` is brought together, in one of two ways.

* Nodes with the same hub are described by their difference from it, the shingles that only one of the two has. Two sets are
  similar if at most a ninth of both sizes together lies in one of them only; with differences of d and e shingles they must
  share at least half of d + e less that ninth. Members of a family with changes of their own share few, so a prefix
  filter on the differences (rare ones first) leaves nearly no pair, where a filter on the sets would meet all at the
  common core. Pairs so near that no shared difference is needed have a member that lies as near to the hub; they are
  taken directly where that one was not linked to it (its words stand in another order).
* Nodes with different hubs are joined by a prefix filter on their sets, rare shingles first.

Verification of a pair: the edit distance of the word sequences, found within a band of
(1 - SIMILARITY) * length diagonals, leaves a similarity of at least ``SIMILARITY``, and the
sets of five-word shingles have a Jaccard similarity of at least ``SIMILARITY``.

Defined results: null and empty texts are one node, equal to each other; texts of fewer than five
words are one k-mer; repeated rows are documents of one class; the class id is the smallest id of the class
(null only if it has no other); of a class the row with the smallest id stays; extra columns
are carried by ``dedup_near``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import attach_once, batches, column_of, cut_swept, mix64, text_bytes
from plateau.llm.components import components

K = 5
SIMILARITY = 0.8
TABLES, PICKS = 24, 4
SHORT = 9

_SEED = mix64(np.arange(1, TABLES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_ODD = mix64(_SEED) | np.uint64(1)


def words_of(t: bytes) -> list[bytes]:
    return t.lower().split()


def kmers(words: list[bytes]) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers in text order."""
    if not words:
        return np.empty(0, np.uint64)
    w = mix64(np.fromiter(map(zlib.crc32, words), np.uint64, len(words)))
    k = min(K, len(w))
    n = len(w) - k + 1
    with np.errstate(over="ignore"):
        h = w[:n].copy()
        for j in range(1, k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[j:n + j]
        order = np.argsort(h, kind="stable")
        s = h[order]
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        if len(first) < n:
            occ = np.empty(n, np.uint64)
            occ[order] = (np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))).astype(np.uint64)
            h = h + occ * np.uint64(0xC2B2AE3D27D4EB4F)
    return mix64(h)


def shingle_set(words: list[bytes]) -> np.ndarray:
    """Hashes of the distinct shingles of ``jaccard``."""
    w = mix64(np.fromiter(map(zlib.crc32, words), np.uint64, len(words)))
    k = min(K, len(w))
    with np.errstate(over="ignore"):
        h = w[:len(w) - k + 1].copy()
        for j in range(1, k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[j:len(w) - k + 1 + j]
    return np.unique(h)


def sketch(h: np.ndarray) -> np.ndarray:
    """One key per table; none where all k-mers are picked anyway (``short_keys`` has these)."""
    n = len(h)
    if n <= PICKS:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        span = max(1, 2_000_000 // n)
        parts = []
        for t in range(0, TABLES, span):
            v = (h[None, :] ^ _SEED[t:t + span, None]) * _ODD[t:t + span, None]
            v ^= v >> np.uint64(32)
            parts.append(np.argpartition(v, PICKS, axis=1)[:, :PICKS])
        at, key = np.sort(np.concatenate(parts), axis=1), _SEED.copy()
        for j in range(PICKS):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + h[at[:, j]])
    return key.view(np.int64)


def short_keys(words: list[bytes]) -> np.ndarray:
    """Keys of a text of at most ``SHORT`` distinct shingles: their set, and the set without each one. Two sets that
    together have at most ``SHORT`` shingles and a Jaccard similarity of ``SIMILARITY`` differ by one at most."""
    if not words:
        return np.empty(0, np.int64)
    v = shingle_set(words)
    if len(v) > SHORT:
        return np.empty(0, np.int64)
    v = mix64(v ^ _SEED[0])
    with np.errstate(over="ignore"):
        whole = v.sum(dtype=np.uint64)
        less = whole - v if len(v) > PICKS else v[:0]   # of fewer shingles one is too much
        key = mix64(np.r_[whole, less] + np.r_[len(v), np.full(len(less), len(v) - 1)].astype(np.uint64) * _ODD[0])
    return key.view(np.int64)


def _node(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def within_band(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    """Whether the edit distance of two sequences is at most ``limit``: furthest-reaching points
    on the diagonals of a band of that width, all diagonals of one distance at once."""
    lo = 0
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return False
    same = np.flatnonzero(a[:min(n, m)] != b[:min(n, m)])
    lo = int(same[0]) if len(same) else min(n, m)
    a, b = a[lo:], b[lo:]
    n, m = len(a), len(b)
    k = min(n, m)
    tail = np.flatnonzero(a[n - k:][::-1] != b[m - k:][::-1]) if k else np.empty(0, int)
    hi = int(tail[0]) if len(tail) else k
    n, m = n - hi, m - hi
    if n == 0 or m == 0:
        return max(n, m) <= limit
    a = np.concatenate([a[:n], [np.uint32(0)]])
    b = np.concatenate([b[:m], [np.uint32(0)]])
    reach = np.full(2 * limit + 5, -2, np.int64)   # rows of ``a`` reached on diagonal d at d + mid
    mid = limit + 2

    def slide(diag: np.ndarray, x: np.ndarray) -> np.ndarray:
        going = np.flatnonzero((x >= 0) & (x < n) & (x + diag >= 0) & (x + diag < m))
        step = 0
        while len(going):
            if len(going) <= 4 and step >= 4:   # the few long runs, block by block
                for g in going.tolist():
                    d, i, size = int(diag[g]), int(x[g]), 64
                    while True:
                        s = min(size, n - i, m - i - d)
                        if s <= 0:
                            break
                        diff = np.flatnonzero(a[i:i + s] != b[i + d:i + d + s])
                        if len(diff):
                            i += int(diff[0])
                            break
                        i, size = i + s, size * 2
                    x[g] = i
                break
            i = x[going]
            going = going[a[i] == b[i + diag[going]]]
            x[going] += 1
            going = going[(x[going] < n) & (x[going] + diag[going] < m)]
            step += 1
        return x

    goal = m - n
    for e in range(limit + 1):
        if e == 0:
            diag, x = np.array([0]), np.array([0])
        else:
            diag = np.arange(-e, e + 1)
            at = diag + mid
            x = np.maximum(np.maximum(reach[at] + 1, reach[at - 1]), reach[at + 1] + 1)
            x = np.minimum(np.minimum(x, n), m - diag)
            x = np.where((x < 0) | (x + diag < 0), -2, x)
        x = slide(diag, x)
        reach[diag + mid] = x
        if abs(goal) <= e and reach[goal + mid] >= n:
            return True
    return False


def jaccard(a: list[bytes], b: list[bytes]) -> float:
    def of(w):
        k = min(K, len(w))
        return set(zip(*(w[j:len(w) - k + 1 + j] for j in range(k)))) if w else set()
    x, y = of(a), of(b)
    return len(x & y) / len(x | y) if x or y else 1.0


def similar(a: list[bytes], b: list[bytes]) -> bool:
    longest = max(len(a), len(b))
    if min(len(a), len(b)) < SIMILARITY * longest or jaccard(a, b) < SIMILARITY:
        return False
    ids: dict[bytes, int] = {}
    x, y = (np.array([ids.setdefault(w, len(ids) + 1) for w in s], np.uint32) for s in (a, b))
    return within_band(x, y, int((1 - SIMILARITY) * longest + 1e-9))


_SKETCH = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("node", pa.binary()), ("keys", pa.list_(pa.int64()))])
_TEXT = pa.schema([("id", pa.int64()), ("node", pa.binary()), ("z", pa.binary())])
_SET = pa.schema([("node", pa.binary()), ("label", pa.binary()), ("ref", pa.binary()), ("ref_label", pa.binary()), ("n", pa.int32()),
                  ("m", pa.int32()), ("hs", pa.list_(pa.int64())), ("ds", pa.list_(pa.int64()))])
_PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("z").alias("za")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("z").alias("zb")), "b"))

    def run(it):
        unz = zstandard.ZstdDecompressor()

        def rows():
            last, wb = None, []
            for r in it:
                for a, b, za, zb in zip(*(column_of(r, c) for c in ("a", "b", "za", "zb"))):
                    if b != last:
                        last, wb = b, unz.decompress(zb).split()
                    if similar(unz.decompress(za).split(), wb):
                        yield a, b
        yield from batches(rows(), _PAIR, 5000)

    found = both.select("a", "b", "za", "zb").mapInArrow(run, "a binary, b binary")
    return cut_swept(found.repartition("a"))   # a few files instead of one small one per task


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, text_hash, class_id, class_size, n_links (verified links of its text from which the class was
    built: to its hub, and those that join components), kept."""
    src = docs.select(F.col(id_col).cast("bigint").alias("id"),
                      F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_hash"),
                      text_bytes(text_col).alias("t"))

    def sketches(it):
        def rows():
            for b in it:
                for i, x, t in zip(*(column_of(b, c) for c in ("id", "text_hash", "t"))):
                    w = words_of(t)
                    yield i, x, _node(w), np.concatenate([sketch(kmers(w)), short_keys(w)])
        yield from batches(rows(), _SKETCH, 2000)

    rows = cut_swept(src.mapInArrow(sketches, "id bigint, text_hash bigint, node binary, keys array<bigint>"))
    nodes = rows.groupBy("node").agg(F.min("id").alias("id"), F.first("keys").alias("keys"))
    inc = nodes.select("node", "id", F.explode("keys").alias("key"))
    sizes = inc.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    inc = cut_swept(inc.join(sizes, "key"))
    found = _links(inc, src)
    if found is None:
        rows = rows.select("id", "text_hash", "node").withColumn("label", F.col("node")).withColumn("n_links", F.lit(0).cast("bigint"))
    else:
        links, label = found
        ends = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node")))
        facts = cut_swept(label.join(ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links")), "node"))
        rows = (rows.select("id", "text_hash", "node").join(facts, "node", "left")
                .withColumn("label", F.coalesce("label", "node")).withColumn("n_links", F.coalesce("n_links", F.lit(0))))
    rows = cut_swept(rows.withColumn("uid", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("id").isNull().alias("no"), F.col("id").alias("class_id"), F.col("uid").alias("keep")))
    g = rows.groupBy("label").agg(F.count(F.lit(1)).alias("class_size"), first.alias("f"))
    return rows.join(g, "label").select("id", "text_hash", F.col("f.class_id").alias("class_id"), "class_size", "n_links",
                                        (F.col("uid") == F.col("f.keep")).alias("kept"))


def _links(inc: DataFrame, src: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Verified links between nodes and the components they make, or None."""
    if inc.isEmpty():
        return None
    # One text per node: that of its smallest id.
    reps = inc.select("node", "id").distinct()

    def texts(it):
        z = zstandard.ZstdCompressor(level=1)

        def rows():
            for b in it:
                for i, t in zip(column_of(b, "id"), column_of(b, "t")):
                    w = words_of(t)
                    yield i, _node(w), z.compress(b" ".join(w))
        yield from batches(rows(), _TEXT, 1000)

    packed = src.select("id", "t").mapInArrow(texts, "id bigint, node binary, z binary")
    found = packed.join(reps, (packed["node"] == reps["node"]) & packed["id"].eqNullSafe(reps["id"]), "left_semi")
    text = cut_swept(found.dropDuplicates(["node"]).select("node", "z"))
    inc = inc.select("key", "node", "size")
    hub = inc.groupBy("node").agg(F.sum("size").alias("score"))
    inc = cut_swept(inc.join(hub, "node"))
    # First each node with the best hub of all its buckets: most of a family is one component then.
    top = inc.groupBy("key").agg(F.max(F.struct("score", "node")).alias("top"))
    best = (inc.join(top, "key").filter("node <> top.node").groupBy("node").agg(F.max("top").alias("top"))
            .select("node", F.col("top.node").alias("hub")))
    tried = cut_swept(_pairs(best))
    links = _verified(tried, text)
    label = components(links)
    lab = inc.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_keys = (lab.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
                 .filter("x <> y").select("key"))
    lab = cut_swept(lab.join(open_keys, "key").select("key", "node", "size", "label"))
    refs = lab.select("node", "label").distinct().join(best, "node", "left").select("node", "label", F.coalesce("hub", "node").alias("ref"))
    of_ref = label.select(F.col("node").alias("ref"), F.col("label").alias("ref_label"))
    nodes = cut_swept(refs.join(of_ref, "ref", "left").withColumn("ref_label", F.coalesce("ref_label", "ref")))
    if nodes.isEmpty():
        return links, label
    pairs = cut_swept(_pairs(_near_pairs(nodes, text)).join(tried, ["a", "b"], "left_anti"))
    if not pairs.isEmpty():
        more = _verified(pairs, text)
        if not more.isEmpty():
            links = links.unionAll(more)
            label = components(links)
    return links, label


def _near_pairs(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (node, hub) of different labels among ``nodes`` (node, label, ref, ref_label): all whose shingle sets have a
    Jaccard similarity of at least ``SIMILARITY`` and some that do not."""
    def sets(it):
        unz, known = zstandard.ZstdDecompressor(), {}

        def rows():
            for b in it:
                for x, label, ref, ref_label, z, zr in zip(*(column_of(b, c) for c in ("node", "label", "ref", "ref_label", "z", "zr"))):
                    if ref not in known:
                        if len(known) >= 64:
                            known.clear()
                        known[ref] = shingle_set(unz.decompress(zr).split())
                    h = shingle_set(unz.decompress(z).split())
                    d = np.setxor1d(h, known[ref])
                    yield x, label, ref, ref_label, len(h), len(known[ref]), h.view(np.int64), d.view(np.int64)
        yield from batches(rows(), _SET, 500)

    both = (nodes.join(texts, "node").join(texts.select(F.col("node").alias("ref"), F.col("z").alias("zr")), "ref")
            .select("node", "label", "ref", "ref_label", "z", "zr"))
    rows = cut_swept(both.mapInArrow(sets, "node binary, label binary, ref binary, ref_label binary, n int, m int, hs array<bigint>, ds array<bigint>"))
    return _within_families(rows).unionAll(_across_families(rows))


def _within_families(rows: DataFrame) -> DataFrame:
    """Pairs with the same ref. With differences of d and d2 shingles from it, sets of n and n2 are similar if and only if
    they share at least (d + d2 - (n + n2) / 9) / 2 of these. The first shared one in the common order is followed by the
    others in both lists; ``rest`` counts what a list still has there, shingles of one set alone not counted. As no list
    shares more than it has, a node must keep at least d - (n + n2) / 9 >= d - n / 4."""
    one = rows.select("node", "label", "ref", "n", F.size("ds").alias("d"), F.explode("ds").alias("h"))
    often = one.groupBy("ref", "h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    listed = (one.join(often, ["ref", "h"]).groupBy("node", "label", "ref", "n", "d")
              .agg(F.array_sort(F.collect_list(F.struct("c", "h"))).alias("l")))
    at = cut_swept(listed.select("node", "label", "ref", "n", "d", F.size("l").alias("s"), F.posexplode("l").alias("i", "x"))
             .select("node", "label", "ref", "n", "d", (F.col("s") - F.col("i")).alias("rest"), F.col("x.h").alias("h"))
             .filter("4 * rest >= 4 * d - n"))
    hub = at.select("ref", "h", F.col("node").alias("hub"), F.col("label").alias("l2"), F.col("n").alias("n2"), F.col("d").alias("d2"),
                    F.col("rest").alias("rest2"))
    alike = "label <> l2 and 5 * least(n, n2) >= 4 * greatest(n, n2)"
    met = (at.join(hub, ["ref", "h"]).filter(f"node < hub and {alike} and 18 * least(rest, rest2) >= 9 * (d + d2) - (n + n2)")
           .select("node", "hub").distinct())
    # Near to the ref in words but not linked to it.
    sized = rows.select("node", "label", "ref", "ref_label", "n", "m", F.size("ds").alias("d"))
    turned = sized.filter("label <> ref_label and 9 * d <= n + m").select("node", "label", "ref", "n", "d")
    near = sized.select("ref", F.col("node").alias("hub"), F.col("label").alias("l2"), F.col("n").alias("n2"), F.col("d").alias("d2"))
    return met.unionAll(turned.join(near, "ref").filter(f"{alike} and 9 * (d + d2) <= n + n2").select("node", "hub"))


def _across_families(rows: DataFrame) -> DataFrame:
    """Pairs with different refs. Each set is listed rare shingles first. For a pair at 4/5 the shared shingles are at least
    4/9 of both sizes together, so the first shared one stands at most at a ninth of the smaller set and a fifth of the
    larger, and what follows it in each list is long enough. The pair meets at this shingle."""
    one = rows.select("node", "label", "ref", "n", F.explode("hs").alias("h"))
    often = (one.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("ref").alias("x"), F.max("ref").alias("y"))
             .filter("c > 1").withColumn("meets", F.col("x") != F.col("y")).drop("x", "y"))
    # Shingles of one set alone come first in its list; they are counted, not listed.
    listed = (one.join(often, "h").groupBy("node", "label", "ref", "n")
              .agg(F.array_sort(F.collect_list(F.struct("c", "h", "meets"))).alias("l"))
              .select("node", "label", "ref", "n", (F.col("n") - F.size("l")).alias("alone"), "l").filter("5 * alone <= n"))
    at = cut_swept(listed.select("node", "label", "ref", "n", "alone", F.posexplode("l").alias("i", "s")).filter("s.meets")
             .select("node", "label", "ref", "n", (F.col("n") - F.col("alone") - F.col("i")).alias("rest"), F.col("s.h").alias("h"))
             .filter("5 * rest >= 4 * n"))
    hub = at.select("h", F.col("node").alias("hub"), F.col("label").alias("l2"), F.col("ref").alias("ref2"), F.col("n").alias("n2"),
                    F.col("rest").alias("rest2"))
    return (at.filter("9 * rest >= 8 * n").join(hub, "h")
            .filter("label <> l2 and ref <> ref2 and (n < n2 or n = n2 and node < hub) and 5 * n >= 4 * n2 "
                    "and 9 * least(rest, rest2) >= 4 * (n + n2)")
            .select("node", "hub").distinct())


def _pairs(df: DataFrame) -> DataFrame:
    """Distinct unordered pairs (a < b) of (node, hub)."""
    return df.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def dedup_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that stay: one of each class."""
    c = near_classes(docs, id_col, text_col)
    facts = cut_swept(c.groupBy(F.col("id").alias("_fid"), F.col("text_hash").alias("_fh"))
                .agg(F.count(F.lit(1)).alias("m"), F.max("kept").alias("_kept")).filter("_kept").drop("_kept"))
    keys = {"_fid": F.col(id_col).cast("bigint"),
            "_fh": F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))}
    return attach_once(docs, facts, keys)[0]
