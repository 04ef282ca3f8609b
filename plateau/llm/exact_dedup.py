"""Exact dedup by composable polynomial fingerprints, confirmed by chunkwise comparison.

Normal form of a text: its UTF-8 without the characters ``[\\x20\\x09-\\x0D]`` (null: empty).
Its fingerprint is the polynomial hash of the bytes modulo a prime, in two bases. A text is
cut into chunks; one matrix product hashes all chunks at once, and neighbouring hashes are
joined by ``h(a + b) = h(a) * B**len(b) + h(b)`` in a tree, so no step is sequential in the
length. Rows with equal (fingerprint, length) are then compared byte by byte in chunks: a
group is cut into parts of about ``FAN`` rows, a part streams through a task sorted by
fingerprint and holds one text at a time, and the parts' first texts are compared in the next
level in the same way. Equality is transitive, so a group of any size needs
log(size) / log(FAN) levels and no task sees a whole group. A fingerprint whose texts differ
(a collision) is split by the texts' SHA-256.

Defined results: null texts are empty texts; empty texts are equal to each other; rows with a
null id take part, and sort after all ids; repeated rows (same id and text) are separate rows
of which one is kept; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import SPACE, attach_once, batches, column_of, cut, text_bytes

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 845_321_593)
CHUNK = 4096   # 255 * 2**31 * 4096 < 2**53: a chunk's dot product is exact in doubles
FAN = 64


def _powers(prime: int, bases: tuple[int, int]) -> np.ndarray:
    out = np.empty((CHUNK, 2))
    for j, b in enumerate(bases):
        x = 1
        for i in range(CHUNK - 1, -1, -1):
            out[i, j] = x
            x = x * b % prime
    return out


class Fingerprint:
    """Polynomial fingerprints; ``combine`` joins those of two adjacent pieces."""

    def __init__(self, prime: int = PRIME, bases: tuple[int, int] = BASES):
        self.prime, self.bases = prime, bases
        self.pow = _powers(prime, bases)

    def of(self, data: bytes) -> tuple[int, int]:
        n = len(data)
        if n <= CHUNK:
            h = np.frombuffer(data, np.uint8).astype(np.float64) @ self.pow[CHUNK - n:]
            return int(h[0]) % self.prime, int(h[1]) % self.prime
        m = -(-n // CHUNK)
        a = np.zeros(m * CHUNK, np.uint8)
        a[m * CHUNK - n:] = np.frombuffer(data, np.uint8)
        p = np.uint64(self.prime)
        h = np.concatenate([(a[i * CHUNK:(i + 64) * CHUNK].reshape(-1, CHUNK).astype(np.float64) @ self.pow)
                            for i in range(0, m, 64)]).astype(np.uint64) % p
        shift = np.array([pow(b, CHUNK, self.prime) for b in self.bases], np.uint64)
        while len(h) > 1:
            if len(h) % 2:
                h = np.concatenate([np.zeros((1, 2), np.uint64), h])
            h = (h[0::2] * shift + h[1::2]) % p
            shift = shift * shift % p
        return int(h[0, 0]), int(h[0, 1])

    def combine(self, left: tuple[int, int], right: tuple[int, int], right_len: int) -> tuple[int, int]:
        return tuple((x * pow(b, right_len, self.prime) + y) % self.prime
                     for x, y, b in zip(left, right, self.bases))


def same(a: bytes, b: bytes, chunk: int = 1 << 16) -> bool:
    """Compare chunk by chunk, without copies, up to the first difference."""
    if len(a) != len(b):
        return False
    va, vb = memoryview(a), memoryview(b)
    return all(va[i:i + chunk] == vb[i:i + chunk] for i in range(0, len(a), chunk))


_FP = pa.schema([("uid", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                 ("len", pa.int64()), ("sha", pa.string())])
_TX = pa.schema([("id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("len", pa.int64()), ("z", pa.binary())])
_CMP = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("len", pa.int64()), ("part", pa.int64()),
                  ("parts", pa.int64()), ("ok", pa.bool_()), ("z", pa.binary())])


def _ddl(s: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in s)


def _compare(it):
    """Rows sorted by (h1, h2, len, part): one row per part with the verdict."""
    unz = zstandard.ZstdDecompressor()

    def rows():
        key, first, z, ok = None, None, None, True
        for b in it:
            for *k, data in zip(*(column_of(b, c) for c in ("h1", "h2", "len", "part", "parts", "z"))):
                if k != key:
                    if key is not None:
                        yield (*key, ok, z if key[4] > 1 else None)
                    key, first, z, ok = k, unz.decompress(data), data, True
                elif ok and not (data == z or same(first, unz.decompress(data))):
                    ok = False
        if key is not None:
            yield (*key, ok, z if key[4] > 1 else None)

    yield from batches(rows(), _CMP, 500)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 prime: int = PRIME, bases: tuple[int, int] = BASES) -> DataFrame:
    """One row per document: uid (row number of no meaning), id, n (code points), sha,
    keep_id, group_size, kept."""
    src = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("bigint").alias("id"),
                      F.char_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("bigint").alias("n"),
                      text_bytes(text_col).alias("t"))

    def prints(it):
        fp = Fingerprint(prime, bases)

        def rows():
            for b in it:
                for u, i, n, t in zip(*(column_of(b, c) for c in ("uid", "id", "n", "t"))):
                    t = t.translate(None, SPACE)
                    yield (u, i, n, *fp.of(t), len(t), hashlib.sha256(t).hexdigest())
        yield from batches(rows(), _FP)

    d = cut(src.mapInArrow(prints, _ddl(_FP)))
    key = ["h1", "h2", "len"]
    sizes = d.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    top = sizes.agg(F.max("size")).first()[0]
    bad = _collisions(src, sizes, top or 0, prime, bases)
    if bad is None:
        d = d.withColumn("alt", F.lit(""))
    else:
        d = d.join(bad, key, "left").withColumn("alt", F.when(F.col("bad"), F.col("sha")).otherwise(""))
    key.append("alt")
    best = F.min(F.struct((-F.col("n")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("keep_id"),
                          F.col("uid").alias("keep_uid")))
    g = d.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), best.alias("k"))
    return (d.join(g, key).select("uid", "id", "n", "sha", F.col("k.keep_id").alias("keep_id"), "group_size",
                                  (F.col("uid") == F.col("k.keep_uid")).alias("kept")))


def _collisions(src: DataFrame, sizes: DataFrame, top: int, prime: int, bases: tuple[int, int]) -> DataFrame | None:
    """Fingerprints shared by different texts, or None."""
    if top < 2:
        return None

    def texts(it):
        fp, z = Fingerprint(prime, bases), zstandard.ZstdCompressor(level=1)

        def rows():
            for b in it:
                for i, t in zip(column_of(b, "id"), column_of(b, "t")):
                    t = t.translate(None, SPACE)
                    yield (i, *fp.of(t), len(t), z.compress(t))
        yield from batches(rows(), _TX, 500)

    key = ["h1", "h2", "len"]
    parts = F.ceil(F.col("size") / FAN)
    level = (src.select("id", "t").mapInArrow(texts, _ddl(_TX)).join(sizes, key)
             .select(*key, F.pmod(F.xxhash64("id", F.crc32("z")), parts).alias("part"), parts.alias("parts"), "z"))
    found = []
    while True:
        ks = [*key, "part"]
        out = cut(level.repartition(*ks).sortWithinPartitions(*ks).mapInArrow(_compare, _ddl(_CMP)))
        found.append(out.filter(~F.col("ok")).select(*key))
        top = -(-top // FAN)
        if top < 2:
            break
        more = F.ceil(F.col("parts") / FAN)
        level = (out.filter("parts > 1")
                 .select(*key, F.floor(F.col("part") / FAN).alias("part"), more.alias("parts"), "z"))
    bad = found[0]
    for x in found[1:]:
        bad = bad.unionAll(x)
    bad = cut(bad.distinct().withColumn("bad", F.lit(True)))
    return None if bad.isEmpty() else bad


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The documents that stay, with all their columns: of each group of equal texts the row
    with the most code points, then the smallest id."""
    g = exact_groups(docs, id_col, text_col, **kw)
    facts = cut(g.groupBy(F.col("id").alias("_fid"), F.col("sha").alias("_fsha"), F.col("n").alias("_fn"))
                .agg(F.count(F.lit(1)).alias("m"), F.max("kept").alias("_kept"))
                .filter("_kept").drop("_kept"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = {"_fid": F.col(id_col).cast("bigint"),
            "_fsha": F.sha2(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "").cast("binary"), 256),
            "_fn": F.char_length(text).cast("bigint")}
    return attach_once(docs, facts, keys)[0]
