"""Training-data queries over the orders x lineitem interactions (A02-A06, F21, J04, N01,
N02, P08, X07, I03, L01-L03, S09, S11-S13)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plateau.config import EXCLUDED_COLUMNS
from plateau.operators import features as FE
from plateau.operators import pairs as PR
from plateau.operators import splits as SP
from plateau.operators.profiles import user_profiles
from plateau.plans.canonical import canon_sql
from plateau.plans.queries.sql_training import AS_OF, FEATURE_TYPES, ctes
from plateau.plans.registry import query
from plateau.session import checkpoint_dir, hold, store, sweep
from plateau.sources import fixtures as X
from plateau.sources import io as IO



def _tok_sql(x: str) -> str:
    w = f"regexp_extract_all(lower(coalesce({x}, '')), '\\b\\w\\w+\\b')"
    return (f"list_concat({w}, CASE WHEN len({w}) >= 2 THEN list_transform(range(1, len({w})), "
            f"lambda j: {w}[j] || ' ' || {w}[j + 1]) ELSE []::VARCHAR[] END)")


_W = "WITH " + ctes(X.SQL_INTERACTIONS_LARGE)


def _sql(body: str, types: dict | None = None) -> str:
    return canon_sql(_W + body, types or {})


def _inputs(spark, sf_dir):
    i = hold(X.interactions_large(spark, sf_dir))
    cat = hold(FE.catalog_features(X.catalog_raw(spark, sf_dir), X.bridge(spark, sf_dir)))
    return i, cat, X.bridge(spark, sf_dir)


def _stored_inputs(spark, sf_dir):
    """The same for a job of many branches."""
    i = store(X.interactions_large(spark, sf_dir))
    cat = store(FE.catalog_features(X.catalog_raw(spark, sf_dir), X.bridge(spark, sf_dir)))
    return i, cat, X.bridge(spark, sf_dir)


def _pairs(i, cat):
    return PR.user_item_pairs(i, cat, 4, 42)


def _elig(i, cat):
    """Read once by its caller, or stored there."""
    return PR.user_item_pairs(i, cat, 4, 42, rule="eq1")


def _stored_elig(spark, sf_dir):
    i, cat, _ = _stored_inputs(spark, sf_dir)
    return store(_elig(i, cat))


_PAIR_T = {"rating": "d", "label": "d", "datetime": "ts"}


@query("A02_positive_pairs", _sql("SELECT * FROM pos", _PAIR_T))
def a02_positive_pairs(spark, sf_dir):
    """Positive pairs with the highest-engagement event and graded label."""
    return PR.positive_pairs(X.interactions_large(spark, sf_dir))


@query("A04_reengagement_stats", _sql("SELECT * FROM re", {
    "user_recipe_interaction_count": "i", "user_recipe_max_rating": "d", "user_recipe_avg_rating": "d",
    "user_recipe_last_interaction": "ts"}))
def a04_reengagement_stats(spark, sf_dir):
    return PR.reengagement_stats(X.interactions_large(spark, sf_dir))


@query("A05_author_counts", _sql("SELECT * FROM ac", {"user_author_interaction_count": "i"}))
def a05_author_counts(spark, sf_dir):
    i, cat, _ = _inputs(spark, sf_dir)
    return FE.author_counts(i, cat)


@query("A06_bridge_stats", _sql("SELECT * FROM bs", {"ingredient_count": "i", "unique_ingredients": "i"}))
def a06_bridge_stats(spark, sf_dir):
    return FE.bridge_stats(X.bridge(spark, sf_dir))


@query("F21_catalog_features", _sql("SELECT * FROM cat", {
    "total_time": "d", "servings": "i", "ingredient_count": "i", "unique_ingredients": "i", "complexity_score": "d"}))
def f21_catalog_features(spark, sf_dir):
    """Catalog with bridge statistics and complexity."""
    return _inputs(spark, sf_dir)[1]


@query("J04_add_bridge_count", _sql("""
SELECT p.*, b.ingredient_count_db FROM pos p
LEFT JOIN (SELECT recipe_id, count(ingredient_id) AS ingredient_count_db FROM br GROUP BY recipe_id) b USING (recipe_id)
""", {**_PAIR_T, "ingredient_count_db": "i"}))
def j04_add_bridge_count(spark, sf_dir):
    return FE.add_bridge_count(PR.positive_pairs(X.interactions_large(spark, sf_dir)), X.bridge(spark, sf_dir))


@query("N01_negative_samples", _sql("SELECT * FROM neg", {"rating": "d", "label": "d"}))
def n01_negative_samples(spark, sf_dir):
    """Seeded untouched items per user, min(4 x positives, untouched) of them."""
    i, cat, _ = _inputs(spark, sf_dir)
    return PR.negative_samples(PR.positive_pairs(i), cat, 4, 42)


@query("N02_user_item_pairs", _sql("SELECT * FROM pairs", _PAIR_T))
def n02_user_item_pairs(spark, sf_dir):
    i, cat, _ = _stored_inputs(spark, sf_dir)
    return _pairs(i, cat)


@query("S08_bucketed_join", _sql("""
SELECT p.*, f.total_interactions, f.avg_rating, f.activity_days FROM pairs p JOIN prof f USING (user_id)""",
                                 {**_PAIR_T, "total_interactions": "i", "avg_rating": "d", "activity_days": "i"}))
def s08_bucketed_join(spark, sf_dir):
    """All pairs with their users' profiles, both written bucketed by user: the join moves neither."""
    i, cat, _ = _stored_inputs(spark, sf_dir)
    base, tag = checkpoint_dir(spark).rstrip("/"), uuid.uuid4().hex
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = IO.write_bucketed(_pairs(i, cat), f"pairs_{tag}", f"{base}/pairs-{tag}", ["user_id"], n)
    prof = IO.write_bucketed(user_profiles(i).select("user_id", "total_interactions", "avg_rating", "activity_days"), f"profiles_{tag}",
                             f"{base}/profiles-{tag}", ["user_id"], n)
    sweep(spark)
    return pairs.join(prof.hint("merge"), "user_id")


@query("N02_class_counts", _sql("""
SELECT label > 0 AS positive, count(*) AS pairs, count(*) / (SELECT count(*) FROM pairs) * 100 AS percentage
FROM pairs GROUP BY ALL""", {"pairs": "i", "percentage": "d"}))
def n02_class_counts(spark, sf_dir):
    i, cat, _ = _stored_inputs(spark, sf_dir)
    return PR.class_counts(_pairs(i, cat))


@query("P08_eligible_pairs", _sql("""
, one AS MATERIALIZED (SELECT DISTINCT user_id FROM pos WHERE label = 1.0),
known AS MATERIALIZED (SELECT DISTINCT user_id FROM i)
SELECT p.* FROM pairs p JOIN one USING (user_id) JOIN known USING (user_id)""", _PAIR_T))
def p08_eligible_pairs(spark, sf_dir):
    """Pairs of users with at least one pair labelled exactly 1 (D2, rule 'eq1')."""
    i, cat, _ = _stored_inputs(spark, sf_dir)
    return _elig(i, cat)


@query("X07_ingredient_similarity", _sql("""
SELECT e.*, CASE WHEN s.nu > 0 AND s.nr > 0 THEN s.ov / (s.nu + s.nr - s.ov) ELSE 0.0 END AS ingredient_similarity_score,
       CASE WHEN s.nu > 0 AND s.nr > 0 THEN s.ov ELSE 0 END AS ingredient_overlap_count,
       CASE WHEN s.nu > 0 AND s.nr > 0 AND s.ov > 0 THEN 1 ELSE 0 END AS has_common_ingredients
FROM elig e LEFT JOIN sims s USING (user_id, recipe_id)
""", {**_PAIR_T, "ingredient_similarity_score": "d", "ingredient_overlap_count": "i", "has_common_ingredients": "i"}))
def x07_ingredient_similarity(spark, sf_dir):
    i, cat, br = _stored_inputs(spark, sf_dir)
    return FE.ingredient_similarity(store(_elig(i, cat)), i, br)


def _features(spark, sf_dir):
    i, cat, br = _stored_inputs(spark, sf_dir)
    return FE.training_features(store(_elig(i, cat)), user_profiles(i), cat, br, i, as_of=AS_OF)


@query("I03_training_features", _sql("SELECT * FROM ti", FEATURE_TYPES))
def i03_training_features(spark, sf_dir):
    """The full training feature table (J01, J02, J04-J06, F22-F25, X07, I01, I02) with
    recency as of 2024-02-15."""
    return _features(spark, sf_dir)


_SPLIT_SQL = """
, sp AS (
  SELECT e.*, CASE WHEN pos <= floor(n * 0.2) THEN 'test' WHEN pos <= floor(n * 0.2) + floor(n * 0.2) THEN 'val'
                   ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {h}, user_id, recipe_id) AS pos,
               count(*) OVER (PARTITION BY label) AS n FROM elig) e)
"""
from plateau.functions.hashing import sql_md5_int  # noqa: E402

_SPLIT = _SPLIT_SQL.format(h=sql_md5_int("'42'", "user_id", "recipe_id"))


@query("L01_stratified_split", _sql(_SPLIT + "SELECT * EXCLUDE (pos, n) FROM sp", _PAIR_T))
def l01_stratified_split(spark, sf_dir):
    """Seeded 60/20/20 split stratified on the label (exact per-class counts)."""
    return SP.stratified_split(_stored_elig(spark, sf_dir))


@query("L02_temporal_split", _sql("""
SELECT * EXCLUDE (pos, n), CASE WHEN pos > n - floor(n * 0.2) THEN 'test'
                       WHEN pos > n - floor(n * 0.2) - floor(n * 0.2) THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY datetime IS NULL, datetime, user_id, recipe_id) AS pos,
             count(*) OVER () AS n FROM elig)
""", _PAIR_T))
def l02_temporal_split(spark, sf_dir):
    """Last 20 % in time order -> test, previous 20 % -> val (NULL times last)."""
    return SP.temporal_split(_stored_elig(spark, sf_dir))


@query("L03_split_report", _sql(_SPLIT + """
SELECT split, count(*) AS rows, count(*) / (SELECT count(*) FROM sp) AS share FROM sp GROUP BY split
""", {"rows": "i", "share": "d"}))
def l03_split_report(spark, sf_dir):
    return SP.split_report(SP.stratified_split(_stored_elig(spark, sf_dir)))


_NUMERIC_SQL = """(SELECT column_name FROM (DESCRIBE SELECT * FROM ti)
  WHERE column_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'HUGEINT', 'FLOAT', 'DOUBLE') OR column_type LIKE 'DECIMAL%')"""
_SKIPPED = ", ".join(f"'{c}'" for c in [*EXCLUDED_COLUMNS, "label", "rating", "user_id", "recipe_id", "split"])


@query("S09_training_metadata", _sql(f"""
SELECT count(*) AS total_samples, count(DISTINCT user_id) AS n_users, count(DISTINCT recipe_id) AS n_recipes,
       avg(CAST(label = 1.0 AS DOUBLE)) AS positive_ratio,
       (SELECT count(*) FROM {_NUMERIC_SQL} WHERE column_name NOT IN ({_SKIPPED})) AS n_features,
       (SELECT string_agg(column_name, '|' ORDER BY column_name) FROM {_NUMERIC_SQL} WHERE column_name NOT IN ({_SKIPPED})) AS feature_columns
FROM ti""", {"total_samples": "i", "n_users": "i", "n_recipes": "i", "positive_ratio": "d", "n_features": "i"}))
def s09_training_metadata(spark, sf_dir):
    """Metadata of the whole feature table; the feature list is chosen from its schema."""
    m = IO.training_metadata(_features(spark, sf_dir))
    return m.withColumn("feature_columns", F.array_sort("feature_columns"))


@query("S11_validate", _sql("""
SELECT count(*) > 0 AS ok, count(*) AS n_rows, '' AS missing FROM cat""", {"n_rows": "i"}))
def s11_validate(spark, sf_dir):
    return IO.validate(_inputs(spark, sf_dir)[1], ["recipe_id", "recipe_name", "author_name", "total_time"])


@query("S11_validate_missing", _sql("""
SELECT false AS ok, count(*) AS n_rows, 'no_such_column,nor_this' AS missing FROM cat""", {"n_rows": "i"}))
def s11_validate_missing(spark, sf_dir):
    """A required column is missing."""
    return IO.validate(_inputs(spark, sf_dir)[1], ["recipe_id", "no_such_column", "recipe_name", "nor_this"])


_RECIPE_COLUMNS = ("recipe_id", "recipe_name", "author_id", "author_name", "total_time", "servings", "tags", "description", "recipe_url")


def _first_sql(cols) -> str:
    return "concat_ws(chr(10), " + ", ".join(f"'{c}: ' || CAST({c} AS VARCHAR)" for c in cols) + ")"


@query("S13_source_summary", canon_sql(f"""
WITH r AS ({X.SQL_CATALOG_RAW}), g AS ({X.SQL_INGREDIENTS}), b AS ({X.SQL_BRIDGE})
SELECT t.*, (SELECT count(DISTINCT recipe_id) FROM b) AS bridge_recipes,
       (SELECT count(DISTINCT ingredient_id) FROM b) AS bridge_ingredients
FROM (SELECT 'recipes' AS "table", (SELECT count(*) FROM r) AS rows, 9 AS n_columns,
             'recipe_id,recipe_name,author_id,author_name,total_time,servings,tags,description,recipe_url' AS columns,
             (SELECT {_first_sql(_RECIPE_COLUMNS)} FROM r ORDER BY recipe_id LIMIT 1) AS first_row
      UNION ALL SELECT 'ingredients', (SELECT count(*) FROM g), 2, 'id,name', (SELECT {_first_sql(("id", "name"))} FROM g ORDER BY id LIMIT 1)
      UNION ALL SELECT 'recipe_ingredients', (SELECT count(*) FROM b), 2, 'recipe_id,ingredient_id',
             (SELECT {_first_sql(("recipe_id", "ingredient_id"))} FROM b ORDER BY recipe_id, ingredient_id LIMIT 1)) t
""", {"rows": "i", "n_columns": "i", "bridge_recipes": "i", "bridge_ingredients": "i"}))
def s13_source_summary(spark, sf_dir):
    return IO.source_summary(X.catalog_raw(spark, sf_dir), X.ingredients(spark, sf_dir), X.bridge(spark, sf_dir))


@query("S12_profile", canon_sql(f"""
WITH c AS ({X.SQL_CATALOG_RAW})
SELECT * FROM (VALUES ('recipe_id', 'string'), ('recipe_name', 'string'), ('author_id', 'string'),
  ('author_name', 'string'), ('total_time', 'double'), ('servings', 'bigint'), ('tags', 'string'),
  ('description', 'string'), ('recipe_url', 'string')) AS t("column", dtype)
JOIN (UNPIVOT (SELECT count(*) FILTER (WHERE recipe_id IS NULL) AS recipe_id,
          count(*) FILTER (WHERE recipe_name IS NULL) AS recipe_name, count(*) FILTER (WHERE author_id IS NULL) AS author_id,
          count(*) FILTER (WHERE author_name IS NULL) AS author_name, count(*) FILTER (WHERE total_time IS NULL) AS total_time,
          count(*) FILTER (WHERE servings IS NULL) AS servings, count(*) FILTER (WHERE tags IS NULL) AS tags,
          count(*) FILTER (WHERE description IS NULL) AS description, count(*) FILTER (WHERE recipe_url IS NULL) AS recipe_url
        FROM c) ON COLUMNS(*) INTO NAME "column" VALUE null_count) USING ("column")
""", {"null_count": "i"}))
def s12_profile(spark, sf_dir):
    """Column types and NULL counts of the catalog."""
    return IO.profile(X.catalog_raw(spark, sf_dir))


def _catalog_gaps(spark, sf_dir):
    c = X.catalog_raw(spark, sf_dir)
    return c.withColumn("author_name", F.when(F.col("recipe_id").cast("bigint") % 13 == 0, F.lit(None))
                        .otherwise(F.col("author_name")))


@query("I01_I02_impute_catalog", canon_sql(f"""
WITH c AS (SELECT * REPLACE (CASE WHEN CAST(recipe_id AS BIGINT) % 13 = 0 THEN NULL ELSE author_name END AS author_name)
           FROM ({X.SQL_CATALOG_RAW})),
m AS (SELECT author_name AS m FROM c WHERE author_name IS NOT NULL GROUP BY author_name ORDER BY count(*) DESC, author_name LIMIT 1)
SELECT c.* REPLACE (coalesce(CAST(total_time AS DOUBLE), (SELECT coalesce(median(total_time), 0) FROM c)) AS total_time,
                    coalesce(CAST(servings AS DOUBLE), (SELECT coalesce(median(servings), 0) FROM c)) AS servings,
                    coalesce(author_name, (SELECT coalesce(min(m), 'unknown') FROM m)) AS author_name)
FROM c""", {"total_time": "d", "servings": "d"}))
def i01_i02_impute_catalog(spark, sf_dir):
    """Exact-median numeric and modal text imputation of a catalog with gaps."""
    return FE.impute(_catalog_gaps(spark, sf_dir))


@query("T03_training_data_report", _sql(f"""
, sp AS (
  SELECT t.*, CASE WHEN pos <= floor(n * 0.2) THEN 'test' WHEN pos <= floor(n * 0.2) + floor(n * 0.2) THEN 'val'
                   ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {sql_md5_int("'42'", "user_id", "recipe_id")}, user_id, recipe_id) AS pos,
               count(*) OVER (PARTITION BY label) AS n FROM ti) t)
SELECT split, label, count(*) AS rows, count(DISTINCT user_id) AS users, avg(ingredient_similarity_score) AS mean_similarity
FROM sp GROUP BY ALL""", {"label": "d", "rows": "i", "users": "i", "mean_similarity": "d"}))
def t03_training_data_report(spark, sf_dir):
    """End-to-end training-data job (T03): rows, users and mean similarity per split and label."""
    from plateau.plans.training_data import build_training_data, write_training_data
    i, _, br = _inputs(spark, sf_dir)
    td = build_training_data(i, X.catalog_raw(spark, sf_dir), br, as_of=AS_OF)
    out = f"{checkpoint_dir(spark).rstrip('/')}/training-{uuid.uuid4().hex}"
    write_training_data(td, out)          # the feature plan runs once; the report reads its files
    return spark.read.parquet(f"{out}/features").groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("users"),
        F.avg("ingredient_similarity_score").alias("mean_similarity"))


@query("T03_text_features", _sql(f"""
, sp AS (
  SELECT t.*, CASE WHEN pos <= floor(n * 0.2) THEN 'test' WHEN pos <= floor(n * 0.2) + floor(n * 0.2) THEN 'val'
                   ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {sql_md5_int("'42'", "user_id", "recipe_id")}, user_id, recipe_id) AS pos,
               count(*) OVER (PARTITION BY label) AS n FROM ti) t),
rt AS (SELECT * FROM cat WHERE recipe_id IN (SELECT recipe_id FROM sp WHERE split = 'train')),
fr AS (SELECT coalesce(author_id, 'unknown') AS a, count(*) / (SELECT count(*) FROM rt) AS f FROM rt GROUP BY ALL),
nt AS (SELECT recipe_id, count(*) AS n_terms FROM (SELECT recipe_id, unnest({_tok_sql('recipe_name')}) FROM cat) GROUP BY ALL)
SELECT split, count(*) AS rows, sum(coalesce(f, 0)) AS author_freq, sum(coalesce(n_terms, 0)) AS name_terms
FROM sp LEFT JOIN fr ON fr.a = coalesce(sp.author_id, 'unknown') LEFT JOIN nt USING (recipe_id) GROUP BY split""",
                                 {"rows": "i", "author_freq": "d", "name_terms": "d"}))
def t03_text_features(spark, sf_dir):
    """The job with its text step, written and read back by split: author frequencies fitted on the train items,
    name hashing of the catalog (a name's buckets sum to its terms)."""
    from plateau.operators.text import Encoder
    from plateau.plans.training_data import build_training_data, write_training_data
    i, _, br = _inputs(spark, sf_dir)
    td = build_training_data(i, X.catalog_raw(spark, sf_dir), br, as_of=AS_OF,
                             encoders=(Encoder("author_id", "freq", "author_id_freq"), Encoder("recipe_name", "hashing", "name_hash_", 16)))
    out = f"{checkpoint_dir(spark).rstrip('/')}/training-{uuid.uuid4().hex}"
    write_training_data(td, out)
    t = spark.read.parquet(f"{out}/features")
    terms = sum((F.col(f"name_hash_{k}") for k in range(1, 16)), F.col("name_hash_0"))
    return t.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum("author_id_freq").alias("author_freq"),
                                  F.sum(terms).alias("name_terms"))
