"""Benchmark decontamination: a broadcast hash set of the test items' n-grams is held against every window of
the training texts; hits are verified word by word and their words, or the documents, removed. Only DataFrame
functions work on texts.

Words are the runs of digits, a-z (after lower-casing A-Z) and characters from 0x80 on. A window is ``n`` consecutive
words of an item; an item of fewer words, but not none, is one window of all of them. A document word is hit if it lies
in any place where a window occurs.

A window of w words holds exactly one first block of b = ceil(w / 2) words that begins at a multiple of b in the
document. So a document offers n / b blocks, not n windows, to the hash set (64-bit hashes of every block that any window
can show), and only the blocks found there offer the up to b windows that begin at or before them; these are compared with
the items' windows as whole strings. Nothing depends on hashes being free of collisions, and a block that stands in
many windows costs no more than one that stands in one.

Both sets are broadcast while the benchmark has at most ``BROADCAST`` windows; a larger one is joined by shuffles that
adaptive execution splits where a key is hot. Texts are read once and never shuffled: only one row per document and one
per verified hit meet in the final aggregate.

Defined results: null and empty texts, and texts without words, have no words and no hits; null ids and repeated rows each
give a row; rows of ``benchmark`` with the same id are one item; the windows of an item without id hit words but
name no item; items without words are ignored; an empty benchmark hits nothing; extra columns are ignored (``decontaminate``
returns them); an empty table gives an empty result.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import columns, cut, fresh

N = 10
BROADCAST = 400_000   # windows; about 100 bytes each
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"   # the same words before lower-casing


def normal(text: str | Column) -> Column:
    """The text with A-Z in lower case, null as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(c.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def words(text: str | Column) -> Column:
    return F.regexp_extract_all(normal(text), F.lit(WORD), F.lit(0))


def _block(w: Column | int) -> Column:
    """Words of a block for windows of w words."""
    return F.ceil((w if isinstance(w, Column) else F.lit(w)) / 2).cast("int")


def _joined(ws: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(ws, start, size), " ")


def windows_of(items: DataFrame, n: int = N, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per different window: len, words, window (the words with spaces between) and items (its ids as
    strings, sorted)."""
    d = items.select(F.col(id_col).cast("string").alias("item"), words(text_col).alias("ws")).filter(F.size("ws") > 0)
    d = d.withColumn("len", F.least(F.size("ws"), F.lit(n)))
    places = F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("len") + 1)).alias("at")
    d = d.select("item", "len", "ws", places).select("item", "len", F.slice("ws", F.col("at"), F.col("len")).alias("words"))
    return (d.groupBy("len", "words").agg(F.sort_array(F.collect_set("item")).alias("items"))
            .withColumn("window", F.array_join("words", " ")))


def _blocks_of(windows: DataFrame) -> DataFrame:
    """The hashes of every block that a window can show first."""
    shift = F.explode(F.sequence(F.lit(1), _block(F.col("len")))).alias("at")
    d = windows.select("len", "words", shift)
    return d.select(F.xxhash64("len", F.slice("words", F.col("at"), _block(F.col("len")))).alias("block")).distinct()


def _offered(w: int) -> Column:
    """The blocks of a document for windows of w words: hash, place and the words that windows around it need."""
    b = -(-w // 2)
    last = F.floor((F.size("ws") - b) / b).cast("int")
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    # ``padded`` has n words without text in front: the b - 1 words before a block at 0 are there too.
    return F.transform(starts, lambda i: F.struct(
        F.lit(w).alias("len"), (i * b).alias("at"), F.xxhash64(F.lit(w), F.slice("ws", i * b + 1, F.lit(b))).alias("block"),
        F.slice("padded", i * b + F.size("padded") - F.size("ws") - (b - 1) + 1, F.lit(w + b - 1)).alias("near")))


def _windows_near() -> Column:
    """The windows whose first block this is, with their first words' places."""
    b = _block(F.col("len"))
    return F.transform(F.sequence(F.lit(0), b - 1), lambda j: F.struct(
        (F.col("at") - (b - 1) + j).alias("start"), _joined(F.col("near"), j + 1, F.col("len")).alias("window")))


def _covered(spans: str) -> Column:
    """Words in the union of (start, len) spans sorted by start."""
    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(z: Column, x: Column) -> Column:
        end = (x["start"] + x["len"]).cast("bigint")
        return F.struct(F.greatest(z["end"], end).alias("end"),
                        (z["n"] + F.greatest(F.lit(0).cast("bigint"), end - F.greatest(z["end"], x["start"].cast("bigint")))).alias("n"))
    return F.aggregate(spans, zero, add, lambda z: z["n"])


def scan(docs: DataFrame, items: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text",
         key: Column | None = None, item_id: str = "item_id", item_text: str = "text", broadcast: int = BROADCAST) -> DataFrame:
    """One row per document: uid (``key``, else a row number of no meaning), id, n_words, spans (start and len of verified
    windows, in words, sorted), n_hit and items (sorted strings)."""
    known = cut(windows_of(items, n, item_id, item_text))
    count = known.count()
    lengths = sorted(r["len"] for r in known.select("len").distinct().collect())     # n values at most
    blocks = _blocks_of(known).withColumn("known", F.lit(True))
    whole = known.select(F.col("len").alias("of"), F.col("window").alias("same"), "items")
    if count <= broadcast:
        blocks, whole = F.broadcast(blocks), F.broadcast(whole)
    d = docs.select((F.monotonically_increasing_id() if key is None else key).alias("uid"),
                    F.col(id_col).cast("bigint").alias("id"), words(text_col).alias("ws"))
    d = d.select("uid", "id", "ws", F.concat(F.array_repeat(F.lit(""), n), "ws").alias("padded"))
    # Every document also offers one row that finds nothing and stays; its keys differ, so that no join gathers these rows.
    itself = F.array(F.struct(F.lit(0).alias("len"), F.lit(-1).alias("at"), F.xxhash64(F.lit(0), "uid").alias("block"),
                              F.array().cast("array<string>").alias("near")))
    offers = reduce(lambda a, w: F.concat(a, _offered(w)), lengths, itself)
    d = d.select("uid", "id", F.size("ws").alias("n_words"), F.explode(offers).alias("x")).select("uid", "id", "n_words", "x.*")
    d = d.join(blocks, "block", "left").filter(F.col("known") | (F.col("at") < 0))
    none = F.array(F.struct(F.lit(-1).alias("start"), F.concat(F.lit(" "), F.col("uid").cast("string")).alias("window")))
    d = d.select("uid", "id", "n_words", "len", F.explode(F.when(F.col("at") < 0, none).otherwise(_windows_near())).alias("x"))
    d = d.select("uid", "id", "n_words", "len", "x.*")
    d = d.join(whole, (F.col("len") == F.col("of")) & (F.col("window") == F.col("same")), "left")
    d = d.filter(F.col("same").isNotNull() | (F.col("len") == 0))
    hit = F.when(F.col("same").isNotNull(), F.struct("start", "len"))
    g = d.groupBy("uid").agg(F.max("id").alias("id"), F.max("n_words").cast("bigint").alias("n_words"),
                             F.sort_array(F.collect_list(hit)).alias("spans"), F.collect_set("items").alias("lists"))
    g = g.withColumn("items", F.array_sort(F.array_distinct(F.flatten("lists")))).drop("lists")
    return g.withColumn("n_hit", _covered("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``scan``."""
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def _without(text: Column, spans: Column) -> Column:
    """The text without the words of the spans (sorted, apart); what stands before a word goes with it, and what ends the
    text goes if the last word does."""
    gaps, found = F.split(text, CASED, -1), F.regexp_extract_all(text, F.lit(CASED), F.lit(0))
    pieces = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, x: F.concat(g, x))
    ends = F.transform(spans, lambda s: s["start"] + s["len"])
    kept = F.zip_with(F.concat(F.array(F.lit(0)), ends), F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.size(found))),
                      lambda a, b: F.slice(pieces, a + 1, b - a))
    tail = F.when(F.get(ends, F.size(spans) - 1) < F.size(found), F.get(gaps, F.size(found))).otherwise(F.lit(""))
    return F.concat(F.array_join(F.flatten(kept), ""), tail)


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "documents", n: int = N, id_col: str = "doc_id",
                  text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with all their columns, without the documents that are hit (``remove="documents"``) or without the hit words
    in their texts (``"spans"``). A row number is written with the documents first, so that both readings agree."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    uid = fresh(docs, "_uid")
    numbered = cut(docs.withColumn(uid, F.monotonically_increasing_id()))
    found = scan(numbered, items, n, id_col, text_col, key=F.col(f"`{uid}`"), **kw).filter("n_hit > 0")
    if remove == "documents":
        found = found.select(F.col("uid").alias(uid))
        return numbered.join(found, uid, "left_anti").select(*columns(docs))
    spans = fresh(numbered, "_spans")
    found = found.select(F.col("uid").alias(uid), _merged("spans").alias(spans))
    name = next(c for c in docs.columns if c.lower() == text_col.lower())
    d = numbered.join(found, uid, "left")
    clean = F.when(F.col(spans).isNull(), F.col(f"`{name}`")).otherwise(_without(F.col(f"`{name}`"), F.col(spans)))
    return d.select(*[clean.alias(name) if c == name else x for c, x in zip(docs.columns, columns(docs))])


def _merged(spans: str) -> Column:
    """Sorted (start, len) spans, those that overlap or touch as one."""
    zero = F.array().cast("array<struct<start:int,len:int>>")

    def add(a: Column, x: Column) -> Column:
        last = F.get(a, F.size(a) - 1)
        end = F.greatest(last["start"] + last["len"], x["start"] + x["len"])
        longer = F.struct(last["start"].alias("start"), (end - last["start"]).alias("len"))
        one = F.array(F.struct(x["start"].alias("start"), x["len"].alias("len")))
        joins = (F.size(a) > 0) & (x["start"] <= last["start"] + last["len"])
        return F.when(joins, F.concat(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(a, one))
    return F.aggregate(spans, zero, add)
