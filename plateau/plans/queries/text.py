"""Text and parsing queries over the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from plateau.config import DESC_MAX_FEATURES, INSTR_HASH_DIM
from plateau.functions import text as TX
from plateau.functions.hashing import hash_bucket, sql_md5_int
from plateau.operators import text as T
from plateau.operators.pairs import positive_pairs
from plateau.plans.canonical import canon_sql
from plateau.plans.registry import query
from plateau.session import hold
from plateau.sources import fixtures as X


def _catalog_variants(spark, sf_dir):
    """Catalog with tags stored three ways and free-text cooking times / servings."""
    p = X.table(spark, sf_dir, "part")
    c = X.catalog_raw(spark, sf_dir)
    k, size = F.col("p_partkey"), F.col("p_size")
    tags = (F.when(k % 3 == 1, F.concat(F.lower("p_type"), F.lit(", "), F.col("p_name"), F.lit(" |")))
            .when(k % 3 == 2, F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
            .otherwise(F.concat(F.lit('["'), F.lower("p_type"), F.lit('","'),
                                F.regexp_replace("p_name", " ", '","'), F.lit('"]'))))
    cook = (F.when(k % 8 == 0, F.concat((size % 3).cast("string"), F.lit("h "), size.cast("string"), F.lit("m")))
            .when(k % 8 == 1, F.concat((size / 10).cast("string"), F.lit("h")))
            .when(k % 8 == 2, F.concat(size.cast("string"), F.lit("m")))
            .when(k % 8 == 3, size.cast("string"))
            .when(k % 8 == 4, F.lit(""))
            .when(k % 8 == 5, F.lit("soon"))
            .when(k % 8 == 6, F.concat((size % 2).cast("string"), F.lit("h")))
            .otherwise(F.concat(size.cast("string"), F.lit(".5"))))
    serv = (F.when(k % 5 == 0, F.lit("abc")).when(k % 5 == 1, F.concat((size % 9).cast("string"), F.lit(".7")))
            .when(k % 5 == 2, F.lit(None)).otherwise((size % 9).cast("string")))
    v = p.select(F.col("p_partkey").cast("string").alias("recipe_id"), tags.alias("tags_text"),
                 cook.alias("cooking_time"), serv.alias("servings_text"))
    return c.join(v, "recipe_id")


_VARIANTS_SQL = f"""
c AS ({X.SQL_CATALOG_RAW}),
v AS (SELECT CAST(p_partkey AS VARCHAR) AS recipe_id,
        CASE WHEN p_partkey % 3 = 1 THEN lower(p_type) || ', ' || p_name || ' |'
             WHEN p_partkey % 3 = 2 THEN '  ' || p_name || ' '
             ELSE '["' || lower(p_type) || '","' || replace(p_name, ' ', '","') || '"]' END AS tags_text,
        CASE WHEN p_partkey % 8 = 0 THEN CAST(p_size % 3 AS VARCHAR) || 'h ' || CAST(p_size AS VARCHAR) || 'm'
             WHEN p_partkey % 8 = 1 THEN CAST(p_size / 10 AS VARCHAR) || 'h'
             WHEN p_partkey % 8 = 2 THEN CAST(p_size AS VARCHAR) || 'm'
             WHEN p_partkey % 8 = 3 THEN CAST(p_size AS VARCHAR)
             WHEN p_partkey % 8 = 4 THEN ''
             WHEN p_partkey % 8 = 5 THEN 'soon'
             WHEN p_partkey % 8 = 6 THEN CAST(p_size % 2 AS VARCHAR) || 'h'
             ELSE CAST(p_size AS VARCHAR) || '.5' END AS cooking_time,
        CASE WHEN p_partkey % 5 = 0 THEN 'abc' WHEN p_partkey % 5 = 1 THEN CAST(p_size % 9 AS VARCHAR) || '.7'
             WHEN p_partkey % 5 = 2 THEN NULL ELSE CAST(p_size % 9 AS VARCHAR) END AS servings_text
      FROM part),
cv AS (SELECT * FROM c JOIN v USING (recipe_id))
"""


def _tags_sql(col: str) -> str:
    t = f"trim({col})"
    arr = (f"coalesce(CASE WHEN starts_with({t}, '[') THEN TRY_CAST(json({t}) AS VARCHAR[]) END, "
           f"CASE WHEN len(string_split_regex({t}, '[,|]')) = 1 THEN string_split_regex({t}, '\\s+') "
           f"ELSE string_split_regex({t}, '[,|]') END)")
    return (f"CASE WHEN {col} IS NULL OR {t} = '' THEN []::VARCHAR[] ELSE "
            f"list_filter(list_transform({arr}, lambda x: trim(x)), lambda x: x IS NOT NULL AND x <> '') END")


def _sanitize_sql(x: str) -> str:
    s = f"regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '_', 'g'), '_+', '_', 'g')"
    return f"substring(regexp_replace({s}, '^_+|_+$', '', 'g'), 1, 40)"


@query("F12_parse_tags", canon_sql("WITH " + _VARIANTS_SQL + f"""
SELECT recipe_id, {_tags_sql('tags_text')} AS tags_list FROM cv""", {"tags_list": "arr"}))
def f12_parse_tags(spark, sf_dir):
    """Tags stored as JSON, delimited text or words -> clean lists."""
    c = _catalog_variants(spark, sf_dir)
    return c.select("recipe_id", TX.parse_tags(F.col("tags_text")).alias("tags_list"))


@query("F14_sanitize_tag", canon_sql("WITH " + _VARIANTS_SQL + f"""
SELECT recipe_id, list_transform({_tags_sql('tags_text')}, lambda x: {_sanitize_sql('x')}) AS tags_clean FROM cv""",
                                     {"tags_clean": "arr"}))
def f14_sanitize_tag(spark, sf_dir):
    c = _catalog_variants(spark, sf_dir)
    return c.select("recipe_id", F.transform(TX.parse_tags(F.col("tags_text")), TX.sanitize_tag).alias("tags_clean"))


_INTX = "CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN CAST({x} AS BIGINT) END"
_TRUNC = "CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE CAST(trunc({x}) AS BIGINT) END"


def _minutes_sql(col: str) -> str:
    s = f"lower(trim({col}))"
    p0 = f"trim(string_split({s}, 'h')[1])"
    p1 = f"string_split({s}, 'h')[2]"
    rest = f"trim(replace({p1}, 'm', ''))"
    mins = f"CASE WHEN trim({p1}) = '' THEN 0 ELSE {_INTX.format(x=rest)} END"
    h = f"TRY_CAST(trim(replace({s}, 'h', '')) AS DOUBLE) * 60"
    m = f"trim(replace({s}, 'm', ''))"
    return (f"CASE WHEN {col} IS NULL OR {s} = '' THEN NULL "
            f"WHEN contains({s}, 'h') AND contains({s}, 'm') THEN {_INTX.format(x=p0)} * 60 + {mins} "
            f"WHEN contains({s}, 'h') THEN {_TRUNC.format(x=h)} "
            f"WHEN contains({s}, 'm') THEN {_INTX.format(x=m)} "
            f"ELSE {_TRUNC.format(x=f'TRY_CAST({s} AS DOUBLE)')} END")


@query("F10_parse_minutes", canon_sql("WITH " + _VARIANTS_SQL + f"""
SELECT recipe_id, cooking_time, {_minutes_sql('cooking_time')} AS minutes,
       {_TRUNC.format(x='TRY_CAST(trim(servings_text) AS DOUBLE)')} AS servings_n FROM cv""",
                                      {"minutes": "i", "servings_n": "i"}))
def f10_parse_minutes(spark, sf_dir):
    """Cooking-time and servings text -> numbers."""
    c = _catalog_variants(spark, sf_dir)
    return c.select("recipe_id", "cooking_time", TX.parse_minutes(F.col("cooking_time")).alias("minutes"),
                    TX.parse_servings(F.col("servings_text")).alias("servings_n"))


@query("F13_tags_preview", canon_sql("WITH " + _VARIANTS_SQL + """
SELECT recipe_id, array_to_string(string_split(replace(replace(replace(tags_text, '[', ''), ']', ''), '''', ''), ', ')[1:5], ', ') AS tags_preview,
       CASE WHEN length(description) > 20 THEN substring(description, 1, 20) || '...' ELSE description END AS description_short
FROM cv""", {}))
def f13_tags_preview(spark, sf_dir):
    """Display forms: first 5 tags and a 20-character description."""
    c = _catalog_variants(spark, sf_dir)
    return c.select("recipe_id", TX.tags_preview(F.col("tags_text")).alias("tags_preview"),
                    TX.truncate_text(F.col("description"), 20).alias("description_short"))


@query("F31_hash_bucket", canon_sql(f"""
SELECT user_id, ['morning', 'afternoon', 'evening'][{sql_md5_int('user_id')} % 3 + 1] AS time_preference
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id FROM events)""", {}))
def f31_hash_bucket(spark, sf_dir):
    """Stable time-preference bucket per user (md5, same value in every process)."""
    u = X.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("user_id")).distinct()
    names = F.array(F.lit("morning"), F.lit("afternoon"), F.lit("evening"))
    return u.select("user_id", F.element_at(names, (hash_bucket(F.col("user_id"), 3) + 1).cast("int"))
                    .alias("time_preference"))


@query("F32_parse_list", canon_sql("""
SELECT event_id, CAST(json('["' || event_type || '", "' || CAST(user_id % 3 AS VARCHAR) || '"]') AS VARCHAR[]) AS items
FROM events""", {"event_id": "i", "items": "arr"}))
def f32_parse_list(spark, sf_dir):
    """Python-style stored lists parsed as JSON (never evaluated)."""
    ev = X.table(spark, sf_dir, "events")
    s = F.concat(F.lit("['"), F.col("event_type"), F.lit("', '"), (F.col("user_id") % 3).cast("string"), F.lit("']"))
    return ev.select("event_id", TX.parse_list(s).alias("items"))


# -- encoders fitted on the items that have interactions --------------------------------------

_TRAIN_SQL = f"""
i AS ({X.SQL_INTERACTIONS_LARGE}),
rt AS (SELECT * FROM c WHERE recipe_id IN (SELECT recipe_id FROM i))
"""


def _train(spark, sf_dir):
    c = X.catalog_raw(spark, sf_dir)
    return T.train_items(c, X.interactions_large(spark, sf_dir)), c


def _tok_sql(x: str) -> str:
    w = f"regexp_extract_all(lower(coalesce({x}, '')), '\\b\\w\\w+\\b')"
    return (f"list_concat({w}, CASE WHEN len({w}) >= 2 THEN list_transform(range(1, len({w})), "
            f"lambda j: {w}[j] || ' ' || {w}[j + 1]) ELSE []::VARCHAR[] END)")


@query("X01_tag_vocab", canon_sql("WITH " + _VARIANTS_SQL + "," + _TRAIN_SQL + f"""
SELECT tag, count(*) AS count FROM (
  SELECT {_sanitize_sql('unnest(' + _tags_sql('tags') + ')')} AS tag FROM rt) WHERE tag <> ''
GROUP BY tag ORDER BY count DESC, tag LIMIT 50""", {"count": "i"}))
def x01_tag_vocab(spark, sf_dir):
    """Top-50 sanitised tags of the training items."""
    rt, _ = _train(spark, sf_dir)
    return T.fit_tag_vocab(rt, 50)


@query("X01_tag_multi_hot", canon_sql("WITH " + _VARIANTS_SQL + "," + _TRAIN_SQL + f""",
vocab AS (SELECT tag FROM (SELECT tag, count(*) AS n FROM (
  SELECT {_sanitize_sql('unnest(' + _tags_sql('tags') + ')')} AS tag FROM rt) WHERE tag <> ''
  GROUP BY tag ORDER BY n DESC, tag LIMIT 50))
SELECT DISTINCT recipe_id, 'tag__' || tag AS feature, 1.0 AS value FROM (
  SELECT recipe_id, {_sanitize_sql('unnest(' + _tags_sql('tags') + ')')} AS tag FROM c)
WHERE tag IN (SELECT tag FROM vocab)""", {"value": "d"}))
def x01_tag_multi_hot(spark, sf_dir):
    rt, c = _train(spark, sf_dir)
    return T.tag_multi_hot(c, T.fit_tag_vocab(rt, 50))


@query("X02_name_hashing", canon_sql("WITH " + _VARIANTS_SQL + f"""
SELECT recipe_id, 'name_hash_' || CAST({sql_md5_int('term')} % 128 AS VARCHAR) AS feature, CAST(count(*) AS DOUBLE) AS value
FROM (SELECT recipe_id, unnest({_tok_sql('recipe_name')}) AS term FROM c) GROUP BY ALL""", {"value": "d"}))
def x02_name_hashing(spark, sf_dir):
    """Hashing-trick counts of name 1-2-grams into 128 buckets."""
    return T.hash_encode(X.catalog_raw(spark, sf_dir), "recipe_name", 128, "name_hash_")


@query("X02_tags_hashing_binary", canon_sql("WITH " + _VARIANTS_SQL + f"""
SELECT DISTINCT recipe_id, 'tags_hash_' || CAST({sql_md5_int('term')} % 128 AS VARCHAR) AS feature, 1.0 AS value
FROM (SELECT recipe_id, unnest({_tok_sql("array_to_string(" + _tags_sql('tags') + ", ' ')")}) AS term FROM c)""",
                                            {"value": "d"}))
def x02_tags_hashing_binary(spark, sf_dir):
    return T.hash_encode(X.catalog_raw(spark, sf_dir), "tags", 128, "tags_hash_", binary=True, text_of_tags=True)


_TFIDF_SQL = "WITH " + _VARIANTS_SQL + "," + _TRAIN_SQL + f""",
tc AS (SELECT recipe_id, term, count(*) AS tf FROM (SELECT recipe_id, unnest({_tok_sql('description')}) AS term FROM rt)
       GROUP BY ALL),
nd AS (SELECT count(DISTINCT recipe_id) AS n FROM rt),
vocab AS (SELECT term, df, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM (
            SELECT term, sum(tf) AS cf, count(*) AS df FROM tc GROUP BY term ORDER BY cf DESC, term LIMIT 500), nd),
w AS (SELECT t.recipe_id, t.term, t.tf * v.idf AS w FROM (
        SELECT recipe_id, term, count(*) AS tf FROM (SELECT recipe_id, unnest({_tok_sql('description')}) AS term FROM c)
        GROUP BY ALL) t JOIN vocab v USING (term))
"""


@query("X03_tfidf_vocab", canon_sql(_TFIDF_SQL + "SELECT * FROM vocab", {"df": "i", "idf": "d"}))
def x03_tfidf_vocab(spark, sf_dir):
    """Top-500 description 1-2-grams with smooth idf, fitted on the training items."""
    rt, _ = _train(spark, sf_dir)
    return T.fit_tfidf(hold(rt), "description", 500)


@query("X03_tfidf_transform", canon_sql(_TFIDF_SQL + """
SELECT recipe_id, 'desc_tfidf_' || term AS feature,
       w / sqrt(sum(w * w) OVER (PARTITION BY recipe_id)) AS value FROM w""", {"value": "d"}))
def x03_tfidf_transform(spark, sf_dir):
    """L2-normalised TF-IDF of every catalog description (long form)."""
    rt, c = _train(spark, sf_dir)
    return T.tfidf_transform(c, "description", T.fit_tfidf(hold(rt), "description", 500), "desc_tfidf_")


@query("A22_author_freq", canon_sql("WITH " + _VARIANTS_SQL + "," + _TRAIN_SQL + """
SELECT coalesce(author_id, 'unknown') AS author_id, count(*) / (SELECT count(*) FROM rt) AS author_id_freq
FROM rt GROUP BY ALL""", {"author_id_freq": "d"}))
def a22_author_freq(spark, sf_dir):
    rt, _ = _train(spark, sf_dir)
    return T.author_freq(rt)


_SQL_POS = """
pos AS (SELECT user_id, recipe_id,
  CASE WHEN coalesce(w, 1.0) < 0 THEN 0.1 ELSE coalesce(w, 1.0) END AS label FROM (
  SELECT user_id, recipe_id, arg_min(event_type, (-coalesce(w0, 1.0), seq, event_type)) AS ev,
         CASE arg_min(event_type, (-coalesce(w0, 1.0), seq, event_type)) {cases} END AS w
  FROM (SELECT *, CASE event_type {cases} END AS w0 FROM i) GROUP BY user_id, recipe_id))
""".format(cases=" ".join(f"WHEN '{k}' THEN {v}" for k, v in X.WEIGHTS.items()))


@query("A23_author_target", canon_sql("WITH " + _VARIANTS_SQL + "," + _TRAIN_SQL + "," + _SQL_POS + """
SELECT coalesce(rt.author_id, 'unknown') AS author_id, (sum(label) + 1.0) / (count(*) + 2.0) AS author_id_target
FROM pos LEFT JOIN rt USING (recipe_id) GROUP BY ALL""", {"author_id_target": "d"}))
def a23_author_target(spark, sf_dir):
    """Laplace-smoothed label mean per author over the positive pairs."""
    rt, _ = _train(spark, sf_dir)
    return T.author_target(positive_pairs(X.interactions_large(spark, sf_dir)), rt)


@query("X05_encode_author", canon_sql("WITH " + _VARIANTS_SQL + "," + _TRAIN_SQL + "," + _SQL_POS + """,
fr AS (SELECT coalesce(author_id, 'unknown') AS author_id, count(*) / (SELECT count(*) FROM rt) AS author_id_freq
       FROM rt GROUP BY ALL),
tg AS (SELECT coalesce(rt.author_id, 'unknown') AS author_id, (sum(label) + 1.0) / (count(*) + 2.0) AS author_id_target
       FROM pos LEFT JOIN rt USING (recipe_id) GROUP BY ALL)
SELECT recipe_id, coalesce(author_id_freq, 0.0) AS author_id_freq, coalesce(author_id_target, 0.5) AS author_id_target
FROM (SELECT recipe_id, coalesce(author_id, 'unknown') AS author_id FROM c) LEFT JOIN fr USING (author_id)
LEFT JOIN tg USING (author_id)""", {"author_id_freq": "d", "author_id_target": "d"}))
def x05_encode_author(spark, sf_dir):
    rt, c = _train(spark, sf_dir)
    pos = positive_pairs(X.interactions_large(spark, sf_dir))
    return T.encode_author(c, T.author_freq(rt), T.author_target(pos, rt))


# -- the encoders on long texts in four languages ---------------------------------------------

# Tokens are computed once per document; bigrams pair each token with the next one.
_DOC_TERMS = """
dt AS MATERIALIZED (SELECT recipe_id, unnest(w) AS w, unnest(range(len(w))) AS pos FROM (
  SELECT CAST(doc_id AS VARCHAR) AS recipe_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{M}\\p{N}_]{2,}') AS w
  FROM documents)),
terms AS MATERIALIZED (
  SELECT recipe_id, term, count(*) AS tf FROM (
    SELECT recipe_id, w AS term FROM dt UNION ALL
    SELECT recipe_id, w || ' ' || nxt FROM (SELECT recipe_id, w, lead(w) OVER (PARTITION BY recipe_id ORDER BY pos) AS nxt FROM dt)
    WHERE nxt IS NOT NULL) GROUP BY ALL)"""

_DOC_VOCAB = _DOC_TERMS + f""",
vocab AS MATERIALIZED (SELECT term, df, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM (
  SELECT term, sum(tf) AS cf, count(*) AS df FROM terms GROUP BY term ORDER BY cf DESC, term LIMIT {DESC_MAX_FEATURES}),
  (SELECT count(DISTINCT doc_id) AS n FROM documents))"""


def _doc_catalog(spark, sf_dir):
    """Documents as catalog items: the text is description and instruction at once."""
    return X.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("recipe_id"), F.col("text").alias("description"),
        F.col("text").alias("instruction"), F.col("source").alias("author_id"))


@query("F15_sanitize_col", canon_sql("""
SELECT doc_id, substring(regexp_replace(text, '[^a-zA-Z0-9_]+', '_', 'g'), 1, 60) AS name FROM documents""", {"doc_id": "i"}))
def f15_sanitize_col(spark, sf_dir):
    """Column-name form of free text in several alphabets."""
    return X.table(spark, sf_dir, "documents").select("doc_id", TX.sanitize_col(F.col("text")).alias("name"))


@query("X03_documents_vocab", canon_sql("WITH " + _DOC_VOCAB + " SELECT * FROM vocab", {"df": "i", "idf": "d"}))
def x03_documents_vocab(spark, sf_dir):
    """Top-500 terms of whole documents: the cut is exercised and terms are of several alphabets."""
    return T.fit_tfidf(_doc_catalog(spark, sf_dir), "description", DESC_MAX_FEATURES)


@query("X03_documents_tfidf", canon_sql("WITH " + _DOC_VOCAB + """,
w AS (SELECT recipe_id, term, tf * idf AS w FROM terms JOIN vocab USING (term))
SELECT recipe_id, 'desc_tfidf_' || term AS feature, w / sqrt(sum(w * w) OVER (PARTITION BY recipe_id)) AS value FROM w""",
                                        {"value": "d"}))
def x03_documents_tfidf(spark, sf_dir):
    """TF-IDF of whole documents, one row per (document, term): terms never share a feature."""
    c = _doc_catalog(spark, sf_dir)
    return T.tfidf_transform(c, "description", T.fit_tfidf(c, "description", DESC_MAX_FEATURES), "desc_tfidf_")


@query("X02_description_hashing", canon_sql("WITH " + _DOC_TERMS + f"""
SELECT recipe_id, 'desc_hash_' || CAST({sql_md5_int('term')} % {DESC_MAX_FEATURES} AS VARCHAR) AS feature, CAST(sum(tf) AS DOUBLE) AS value
FROM terms GROUP BY ALL""", {"value": "d"}))
def x02_description_hashing(spark, sf_dir):
    return T.hash_encode(_doc_catalog(spark, sf_dir), "description", DESC_MAX_FEATURES, "desc_hash_")


@query("X02_instruction_hashing", canon_sql("WITH " + _DOC_TERMS + f"""
SELECT recipe_id, 'instr_hash_' || CAST({sql_md5_int('term')} % {INSTR_HASH_DIM} AS VARCHAR) AS feature, CAST(sum(tf) AS DOUBLE) AS value
FROM terms GROUP BY ALL""", {"value": "d"}))
def x02_instruction_hashing(spark, sf_dir):
    return T.hash_encode(_doc_catalog(spark, sf_dir), "instruction", INSTR_HASH_DIM, "instr_hash_")


@query("X03_instruction_tfidf_vocab", canon_sql("WITH " + _DOC_VOCAB + " SELECT term, df FROM vocab", {"df": "i"}))
def x03_instruction_tfidf_vocab(spark, sf_dir):
    return T.fit_tfidf(_doc_catalog(spark, sf_dir), "instruction", DESC_MAX_FEATURES).select("term", "df")


@query("X06_text_encoder_long", canon_sql("WITH " + _DOC_VOCAB + f""",
w AS (SELECT recipe_id, term, tf * idf AS w FROM terms JOIN vocab USING (term))
SELECT recipe_id, 'desc_tfidf_' || term AS feature, w / sqrt(sum(w * w) OVER (PARTITION BY recipe_id)) AS value FROM w
UNION ALL
SELECT recipe_id, 'instr_hash_' || CAST({sql_md5_int('term')} % {INSTR_HASH_DIM} AS VARCHAR), CAST(sum(tf) AS DOUBLE)
FROM terms GROUP BY ALL""", {"value": "d"}))
def x06_text_encoder_long(spark, sf_dir):
    """Fit and transform of the whole encoder on documents, in long form."""
    c = _doc_catalog(spark, sf_dir)
    specs = (T.Encoder("author_id", "freq", "author_id_freq"), T.Encoder("description", "tfidf", "desc_tfidf_", DESC_MAX_FEATURES),
             T.Encoder("instruction", "hashing", "instr_hash_", INSTR_HASH_DIM))
    return T.TextEncoder(specs).fit(c.select("recipe_id"), c).transform_long(c)


@query("X06_text_encoder_wide")
def x06_text_encoder_wide(spark, sf_dir):
    """Fit the text encoder on the training items, transform the whole catalog to wide
    columns (author frequency, 50 tag columns, 128 name-hash columns) and attach them to
    the positive pairs (X06, J12). Rows only: the column set depends on the vocabulary."""
    rt, c = _train(spark, sf_dir)
    pos = positive_pairs(X.interactions_large(spark, sf_dir))
    enc = T.TextEncoder().fit(pos, c)
    return T.add_text_features(pos.select("user_id", "recipe_id", "label"), enc.transform(c))
