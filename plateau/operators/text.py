"""Text encodings of the catalog, fitted on the training items.

Everything is kept in long form ``(recipe_id, feature, value)`` while computing —
terms are exploded, counted with ``groupBy`` and joined to small fitted tables whose
size is fixed by a parameter (``top_k``, ``max_features``) — and only pivoted to wide
columns at the end, over a known, bounded column list.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plateau.config import NAME_HASH_DIM, TAGS_TOP_K
from plateau.functions.hashing import md5_int
from plateau.functions.text import ngrams_1_2, parse_tags, sanitize_tag, tokens
from plateau.session import hold


def train_items(catalog: DataFrame, train: DataFrame) -> DataFrame:
    """Catalog rows of items that appear in the training split."""
    return catalog.join(train.select(F.col("recipe_id").cast("string").alias("recipe_id")).distinct(),
                        "recipe_id", "left_semi")


# -- author encodings (A22, A23, X05) --------------------------------------------------

def author_freq(recipes_train: DataFrame, col: str = "author_id") -> DataFrame:
    """Share of training catalog rows per author (NULL -> 'unknown')."""
    a = recipes_train.select(F.coalesce(F.col(col).cast("string"), F.lit("unknown")).alias(col))
    c = a.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    tot = c.agg(F.sum("_n").alias("_t"))  # from the groups' own counts: one scan, one row
    return c.crossJoin(F.broadcast(tot)).select(col, (F.col("_n") / F.col("_t")).alias(f"{col}_freq"))


def author_target(train: DataFrame, recipes_train: DataFrame, col: str = "author_id",
                  label: str = "label") -> DataFrame:
    """Laplace-smoothed label mean ``(sum + 1) / (count + 2)`` per author."""
    t = train if col in train.columns else train.join(recipes_train.select("recipe_id", col), "recipe_id", "left")
    t = t.withColumn(col, F.coalesce(F.col(col).cast("string"), F.lit("unknown")))
    return t.groupBy(col).agg(((F.sum(label) + 1.0) / (F.count(F.lit(1)) + 2.0)).alias(f"{col}_target"))


def encode_author(catalog: DataFrame, freq: DataFrame | None = None, target: DataFrame | None = None,
                  col: str = "author_id") -> DataFrame:
    """Apply the author maps to the catalog; unseen -> 0.0 (freq) / 0.5 (target)."""
    out = catalog.select("recipe_id", F.coalesce(F.col(col).cast("string"), F.lit("unknown")).alias(col))
    if freq is not None:
        out = out.join(freq, col, "left").withColumn(f"{col}_freq", F.coalesce(f"{col}_freq", F.lit(0.0)))
    if target is not None:
        out = out.join(target, col, "left").withColumn(f"{col}_target", F.coalesce(f"{col}_target", F.lit(0.5)))
    return out.drop(col)


# -- tags top-k multi-hot (X01) ----------------------------------------------------------

def tag_rows(catalog: DataFrame, col: str = "tags") -> DataFrame:
    """(recipe_id, tag) per parsed, sanitised tag occurrence (D22: sanitise, then count)."""
    return (catalog.select("recipe_id", F.explode(parse_tags(F.col(col))).alias("_raw"))
            .select("recipe_id", sanitize_tag(F.col("_raw")).alias("tag"))
            .filter(F.col("tag") != ""))


def fit_tag_vocab(recipes_train: DataFrame, k: int = 50) -> DataFrame:
    """The k most frequent tags (occurrences; smaller tag first on ties) with their index."""
    counts = tag_rows(recipes_train).groupBy("tag").agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.col("count").desc(), F.col("tag")).limit(k)  # top-k: the feature
    return top


def tag_multi_hot(catalog: DataFrame, vocab: DataFrame) -> DataFrame:
    """Long form: (recipe_id, 'tag__<tag>', 1.0) for catalog tags in the vocabulary."""
    hits = tag_rows(catalog).join(vocab.select("tag"), "tag").select("recipe_id", "tag").distinct()
    return hits.select("recipe_id", F.concat(F.lit("tag__"), F.col("tag")).alias("feature"),
                       F.lit(1.0).alias("value"))


# -- texts by document -----------------------------------------------------------------------

TASK_ROWS, TASK_CHARS = 50_000, 16_000_000      # texts and characters whose terms a task counts, about
_BROADCAST = 200_000                            # words that go to every task, at most


def by_document(docs: DataFrame, text: Column) -> DataFrame:
    """(recipe_id, words) per row of ``docs``, dealt by id: a text travels once, and what is counted per document afterwards needs no
    exchange and little memory."""
    rows = docs.select("recipe_id", text.alias("_text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("_text")), F.lit(0)).alias("chars")).first()
    parts = max(1, -(-size["n"] // TASK_ROWS), -(-size["chars"] // TASK_CHARS))
    return rows.repartition(parts, "recipe_id").select("recipe_id", tokens(F.col("_text")).alias("words"))


# -- hashing (X02) -------------------------------------------------------------------------

def hash_encode(catalog: DataFrame, col: str, n_features: int, prefix: str, binary: bool = False,
                text_of_tags: bool = False) -> DataFrame:
    """Hashing-trick counts of word 1-2-grams into ``n_features`` buckets (no norm, no sign
    flip); ``binary`` keeps 1.0 per present bucket. Buckets use the stable md5 hash (F31).
    Long form (recipe_id, '<prefix><bucket>', value)."""
    text = F.array_join(parse_tags(F.col(col)), " ") if text_of_tags else F.col(col)
    terms = by_document(catalog, text).select("recipe_id", F.explode(ngrams_1_2(F.col("words"))).alias("term"))
    b = F.pmod(md5_int(F.col("term")), F.lit(n_features))
    agg = F.lit(1.0) if binary else F.count(F.lit(1)).cast("double")
    g = terms.groupBy("recipe_id", b.alias("_b")).agg(agg.alias("value")) if not binary else \
        terms.select("recipe_id", b.alias("_b")).distinct().withColumn("value", F.lit(1.0))
    return g.select("recipe_id", F.concat(F.lit(prefix), F.col("_b").cast("string")).alias("feature"), "value")


# -- TF-IDF (X03) ----------------------------------------------------------------------------

def top_terms(texts: DataFrame, dealt: DataFrame, max_features: int, min_df: int = 1) -> DataFrame:
    """(term, df) of the ``max_features`` word 1-2-grams of the highest corpus frequency (term order on ties) among
    those in >= ``min_df`` documents. Both inputs have the rows (recipe_id, words); ``dealt`` is partitioned by id.

    Words are counted first. Two words are at most as frequent together as each of them alone, so pairs are counted only
    where both words reach the last place, and documents only for terms that reach it."""
    words = hold(texts.select(F.explode("words").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("cf")))

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= _BROADCAST else df

    n = F.size("words")
    two = F.when(n >= 2, F.zip_with(F.slice("words", 1, n - 1), F.slice("words", 2, n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    most = max_features
    while True:
        last = words.orderBy(F.col("cf").desc()).limit(most).agg(F.count(F.lit(1)).alias("n"), F.min("cf").alias("cf")).first()
        least = last["cf"] if 0 < most == last["n"] else 1
        often = words.filter(F.col("cf") >= least)
        key = small(often.select("term"))
        pairs = (texts.select(F.explode(two).alias("_p")).select("_p.a", "_p.b")
                 .join(key.select(F.col("term").alias("a")), "a", "left_semi").join(key.select(F.col("term").alias("b")), "b", "left_semi")
                 .groupBy("a", "b").agg(F.count(F.lit(1)).alias("cf")).filter(F.col("cf") >= least)
                 .select(F.concat("a", F.lit(" "), "b").alias("term"), "cf"))
        terms = often.unionAll(pairs)
        if min_df <= 1:
            terms = F.broadcast(terms.orderBy(F.col("cf").desc(), F.col("term")).limit(max_features))
        else:
            terms = small(hold(terms))
        found = (dealt.select("recipe_id", F.explode(ngrams_1_2(F.col("words"))).alias("term")).join(terms, "term")
                 .select("recipe_id", "term", "cf").distinct()
                 .groupBy("term", "cf").agg(F.count(F.lit(1)).alias("df")))
        if min_df <= 1:
            return found.select("term", "df")
        found = hold(found.filter(F.col("df") >= min_df))
        if least <= min_df or found.count() >= max_features:
            return found.orderBy(F.col("cf").desc(), F.col("term")).limit(max_features).select("term", "df")
        most *= 4


def with_idf(terms: DataFrame, n_docs: int) -> DataFrame:
    """(term, df) with smooth idf ``ln((1 + n) / (1 + df)) + 1``."""
    return terms.select("term", "df", (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def term_weights(dealt: DataFrame, vocab: DataFrame) -> DataFrame:
    """L2-normalised tf * idf (recipe_id, term, w) of rows (recipe_id, words) dealt by id; a document has at most the
    vocabulary's terms, and is put together where its rows are."""
    tf = (dealt.filter(F.col("recipe_id").isNotNull()).select("recipe_id", F.explode(ngrams_1_2(F.col("words"))).alias("term"))
          .join(F.broadcast(vocab.select("term", "idf")), "term")  # <= max_features rows
          .groupBy("recipe_id", "term", "idf").agg(F.count(F.lit(1)).alias("tf")))
    each = tf.groupBy("recipe_id").agg(F.collect_list(F.struct("term", (F.col("tf") * F.col("idf")).alias("w"))).alias("_t"))
    norm = F.sqrt(F.aggregate("_t", F.lit(0.0), lambda t, x: t + x["w"] * x["w"]))
    return (each.select("recipe_id", norm.alias("_norm"), F.explode("_t").alias("_x"))
            .select("recipe_id", F.col("_x.term").alias("term"), (F.col("_x.w") / F.col("_norm")).alias("w")))


def fit_tfidf(recipes_train: DataFrame, col: str, max_features: int = 500, min_df: int = 1) -> DataFrame:
    """Vocabulary (top ``max_features`` terms by corpus frequency, term order on ties, among
    terms in >= ``min_df`` documents) with smooth idf ``ln((1 + n) / (1 + df)) + 1``."""
    texts = recipes_train.select("recipe_id", tokens(F.col(col)).alias("words"))
    n_docs = recipes_train.select("recipe_id").distinct().count()
    return with_idf(top_terms(texts, by_document(recipes_train, F.col(col)), max_features, min_df), n_docs)


def tfidf_transform(docs: DataFrame, col: str, vocab: DataFrame, prefix: str) -> DataFrame:
    """L2-normalised tf * idf over the fitted vocabulary; long form (recipe_id, feature, value)."""
    return term_weights(by_document(docs, F.col(col)), vocab).select(
        "recipe_id", F.concat(F.lit(prefix), F.col("term")).alias("feature"), F.col("w").alias("value"))


def display_names(features: list[str]) -> dict[str, str]:
    """A column name per feature (F15): sanitised, and unique without regard to case. Features whose
    sanitised names agree (terms of other alphabets, 'red fox' and 'red_fox') are numbered in
    their order; features themselves are never merged."""
    names, taken = {}, set()
    for f in features:
        base = name = re.sub(r"[^a-zA-Z0-9_]+", "_", f)[:60]
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        names[f] = name
    return names


# -- fit / transform driver (X06) -----------------------------------------------------------

@dataclass(frozen=True)
class Encoder:
    """One text encoding: ``size`` is the number of buckets or the largest vocabulary."""
    column: str
    method: str      # a key of METHODS
    prefix: str
    size: int = 0


# method -> (fit, transform to long form, ordered features); None where there is nothing to fit.
METHODS = {
    "freq": (lambda rows, train, e: author_freq(rows, e.column), None, None),
    "target": (lambda rows, train, e: author_target(train, rows, e.column), None, None),
    "top_k": (lambda rows, train, e: fit_tag_vocab(rows, e.size), lambda df, e, state: tag_multi_hot(df, state),
              lambda e, state: [f"{e.prefix}{r['tag']}" for r in state.orderBy(F.col("count").desc(), "tag").collect()]),
    "tfidf": (lambda rows, train, e: fit_tfidf(rows, e.column, e.size), lambda df, e, state: tfidf_transform(df, e.column, state, e.prefix),
              lambda e, state: [f"{e.prefix}{r['term']}" for r in state.select("term").orderBy("term").collect()]),
    "hashing": (None, lambda df, e, state: hash_encode(df, e.column, e.size, e.prefix),
                lambda e, state: [f"{e.prefix}{i}" for i in range(e.size)]),
    "hashing_tags": (None, lambda df, e, state: hash_encode(df, e.column, e.size, e.prefix, binary=True, text_of_tags=True),
                     lambda e, state: [f"{e.prefix}{i}" for i in range(e.size)]),
}

DEFAULT_ENCODERS = (Encoder("author_id", "freq", "author_id_freq"), Encoder("tags", "top_k", "tag__", TAGS_TOP_K),
                    Encoder("recipe_name", "hashing", "name_hash_", NAME_HASH_DIM))


@dataclass
class TextEncoder:
    """Fit on the training items, transform any catalog. State = one small DataFrame per fitted encoder."""
    encoders: tuple[Encoder, ...] = DEFAULT_ENCODERS
    state: dict[str, DataFrame] = field(default_factory=dict)

    def _of(self, catalog: DataFrame) -> list[Encoder]:
        return [e for e in self.encoders if e.column in catalog.columns]

    def fit(self, train: DataFrame, catalog: DataFrame) -> "TextEncoder":
        rows = train_items(catalog, train)
        for e in self._of(catalog):
            if METHODS[e.method][0]:
                self.state[e.prefix] = METHODS[e.method][0](rows, train, e)
        return self

    def transform_long(self, catalog: DataFrame) -> DataFrame:
        """(recipe_id, feature, value) of every encoder but the author maps."""
        out = catalog.sparkSession.createDataFrame([], "recipe_id string, feature string, value double")
        for e in self._of(catalog):
            if METHODS[e.method][1]:
                out = out.unionByName(METHODS[e.method][1](catalog, e, self.state.get(e.prefix)))
        return out

    def feature_names(self, catalog: DataFrame) -> dict[str, str]:
        """Feature -> wide column name, in order (collects vocabularies, at most ``size`` rows each)."""
        return display_names([f for e in self._of(catalog) if METHODS[e.method][2]
                              for f in METHODS[e.method][2](e, self.state.get(e.prefix))])

    def transform(self, catalog: DataFrame) -> DataFrame:
        """Wide table: recipe_id + one column per feature (0.0 when absent)."""
        names = self.feature_names(catalog)
        wide = self.transform_long(catalog).groupBy("recipe_id").pivot("feature", list(names)).agg(F.first("value"))
        wide = wide.toDF("recipe_id", *names.values())
        out = catalog.select("recipe_id").distinct()
        for e in self._of(catalog):
            if METHODS[e.method][1] is None:
                maps = {"freq": {"freq": self.state[e.prefix]}, "target": {"target": self.state[e.prefix]}}[e.method]
                out = out.join(encode_author(catalog, col=e.column, **maps), "recipe_id")
        return out.join(wide, "recipe_id", "left").fillna(0.0, subset=list(names.values()))

    def save(self, path: str) -> None:
        for k, df in self.state.items():
            df.write.mode("overwrite").parquet(f"{path}/{k}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, encoders: tuple[Encoder, ...] = DEFAULT_ENCODERS) -> "TextEncoder":
        return cls(encoders, {e.prefix: spark.read.parquet(f"{path}/{e.prefix}") for e in encoders if METHODS[e.method][0]})


def add_text_features(split: DataFrame, encoded: DataFrame) -> DataFrame:
    """Attach encoded catalog columns to a split by item id."""
    return split.join(encoded, "recipe_id", "left")
