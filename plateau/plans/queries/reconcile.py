"""Reconciliation queries: T04 mapping (W01, J08), U02/U03 key sets, A29 report, J03 id mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from plateau.config import RECONCILE_EVENTS
from plateau.operators import reconcile as R
from plateau.plans.canonical import canon_sql
from plateau.plans.reconcile_items import reconcile_items
from plateau.plans.registry import query
from plateau.sources import fixtures as X

_E = f"""WITH e1 AS ({X.sql_recipe_events_versioned('v1')}), e2 AS ({X.sql_recipe_events_versioned('v2')}),
f1 AS (SELECT recipe_url, arg_min(recipe_id, ("timestamp", seq)) AS recipe_id,
              arg_min(recipe_name, ("timestamp", seq)) AS recipe_name,
              arg_min(recipe_author, ("timestamp", seq)) AS recipe_author FROM e1 GROUP BY recipe_url),
f2 AS (SELECT recipe_url, arg_min(recipe_id, ("timestamp", seq)) AS recipe_id,
              arg_min(recipe_name, ("timestamp", seq)) AS recipe_name,
              arg_min(recipe_author, ("timestamp", seq)) AS recipe_author FROM e2 GROUP BY recipe_url),
mapping AS (
  SELECT recipe_url, f1.recipe_id AS v1_recipe_id, f2.recipe_id AS v2_recipe_id,
         coalesce(CASE WHEN f1.recipe_name <> '' THEN f1.recipe_name END, f2.recipe_name) AS recipe_name,
         coalesce(CASE WHEN f1.recipe_author <> '' THEN f1.recipe_author END, f2.recipe_author) AS recipe_author,
         f1.recipe_name IS NOT DISTINCT FROM f2.recipe_name AS are_identical
  FROM f1 JOIN f2 USING (recipe_url))
"""


def _events(spark, sf_dir):
    return X.recipe_events_versioned(spark, sf_dir, "v1"), X.recipe_events_versioned(spark, sf_dir, "v2")


@query("T04_reconcile_mapping", canon_sql(_E + "SELECT * FROM mapping", {}))
def t04_reconcile_mapping(spark, sf_dir):
    """v1 -> v2 item mapping by URL from the first event per URL of each version."""
    return reconcile_items(*_events(spark, sf_dir))[0]


@query("W01_first_per_key", canon_sql(_E + "SELECT 'v1' AS version, * FROM f1 UNION ALL SELECT 'v2' AS version, * FROM f2", {}))
def w01_first_per_key(spark, sf_dir):
    """First event per URL by (timestamp, seq), of both versions."""
    e1, e2 = _events(spark, sf_dir)
    v1, v2 = (R.first_per_key(e, "recipe_url", ["timestamp", "seq"], R.ITEM_FIELDS).withColumn("version", F.lit(v))
              for e, v in ((e1, "v1"), (e2, "v2")))
    return v1.unionByName(v2)


@query("U02_common_keys", canon_sql(_E + "SELECT recipe_url FROM e1 INTERSECT SELECT recipe_url FROM e2", {}))
def u02_common_keys(spark, sf_dir):
    e1, e2 = _events(spark, sf_dir)
    return R.common_keys(e1, e2, "recipe_url")


@query("U03_only_in_v1", canon_sql(_E + "SELECT DISTINCT recipe_url FROM e1 WHERE recipe_url NOT IN (SELECT recipe_url FROM e2)", {}))
def u03_only_in_v1(spark, sf_dir):
    e1, e2 = _events(spark, sf_dir)
    return R.only_in(e1, e2, "recipe_url")


@query("U03_only_in_v2", canon_sql(_E + "SELECT DISTINCT recipe_url FROM e2 WHERE recipe_url NOT IN (SELECT recipe_url FROM e1)", {}))
def u03_only_in_v2(spark, sf_dir):
    e1, e2 = _events(spark, sf_dir)
    return R.only_in(e2, e1, "recipe_url")


@query("U04_distinct_items", canon_sql(f"SELECT DISTINCT recipe_id, event_type FROM ({X.SQL_INTERACTIONS_LARGE})", {}))
def u04_distinct_items(spark, sf_dir):
    """Distinct (item, event type) values of the interactions."""
    return X.interactions_large(spark, sf_dir).select("recipe_id", "event_type").distinct()


@query("A29_reconcile_report", canon_sql(_E + """,
k1 AS (SELECT DISTINCT recipe_url FROM e1), k2 AS (SELECT DISTINCT recipe_url FROM e2)
SELECT (SELECT count(*) FROM k1) AS v1_unique, (SELECT count(*) FROM k2) AS v2_unique,
       (SELECT count(*) FROM k1 JOIN k2 USING (recipe_url)) AS common,
       (SELECT count(*) FROM k1 WHERE recipe_url NOT IN (SELECT recipe_url FROM k2)) AS v1_only,
       (SELECT count(*) FROM k2 WHERE recipe_url NOT IN (SELECT recipe_url FROM k1)) AS v2_only,
       (SELECT count(*) FROM (SELECT recipe_url FROM k1 UNION SELECT recipe_url FROM k2)) AS unique_after,
       (SELECT count(*) FROM k1) + (SELECT count(*) FROM k2) AS unique_before,
       (SELECT count(*) FROM k1) + (SELECT count(*) FROM k2)
         - (SELECT count(*) FROM (SELECT recipe_url FROM k1 UNION SELECT recipe_url FROM k2)) AS duplicates_removed
""", {c: "i" for c in ["v1_unique", "v2_unique", "common", "v1_only", "v2_only", "unique_after",
                       "unique_before", "duplicates_removed"]}))
def a29_reconcile_report(spark, sf_dir):
    return reconcile_items(*_events(spark, sf_dir))[1]


def _v1_style(spark, sf_dir):
    """Event interactions whose v1 rows carry v1-style item ids ('A-<key>')."""
    i = X.interactions_small(spark, sf_dir)
    return i.withColumn("recipe_id", F.when(F.col("version") == "v1", F.concat(F.lit("A-"), F.col("recipe_id")))
                        .otherwise(F.col("recipe_id")))


_J03 = _E + f""", i AS (
  SELECT * REPLACE (CASE WHEN version = 'v1' THEN 'A-' || recipe_id ELSE recipe_id END AS recipe_id)
  FROM ({X.SQL_INTERACTIONS_SMALL})),
m AS (SELECT DISTINCT CAST(v1_recipe_id AS VARCHAR) AS v1, CAST(v2_recipe_id AS VARCHAR) AS v2 FROM mapping),
mapped AS (
  SELECT i.* REPLACE (CASE WHEN m.v2 IS NOT NULL THEN m.v2 ELSE i.recipe_id END AS recipe_id,
                      CASE WHEN m.v2 IS NOT NULL THEN 'v1_mapped_to_v2' ELSE i.version END AS version)
  FROM i LEFT JOIN m ON i.version = 'v1' AND i.recipe_id = m.v1)
"""


@query("J03_map_item_ids", canon_sql(_J03 + "SELECT * FROM mapped",
                                     {"rating": "d", "datetime": "ts", "timestamp": "i", "seq": "i"}))
def j03_map_item_ids(spark, sf_dir):
    """v1 interactions rewritten to v2 ids through the reconciliation mapping."""
    mapping, _ = reconcile_items(*_events(spark, sf_dir))
    return R.map_item_ids(_v1_style(spark, sf_dir), mapping)


@query("J03_mapping_report", canon_sql(_J03 + """
SELECT version, count(*) AS rows, (SELECT count(DISTINCT recipe_id) FROM mapped) AS unique_items_after
FROM mapped GROUP BY version""", {"rows": "i", "unique_items_after": "i"}))
def j03_mapping_report(spark, sf_dir):
    mapping, _ = reconcile_items(*_events(spark, sf_dir))
    return R.mapping_report(R.map_item_ids(_v1_style(spark, sf_dir), mapping))


@query("S07_json_doc_roundtrip", canon_sql(_E + "SELECT * FROM mapping", {}))
def s07_json_doc_roundtrip(spark, sf_dir):
    """The reconciliation mapping written as a JSON document and read back with an
    explicit schema (S07)."""
    import uuid

    from plateau.session import checkpoint_dir
    from plateau.sources.io import read_json_doc, write_json_doc
    mapping, _ = reconcile_items(*_events(spark, sf_dir))
    path = f"{checkpoint_dir(spark).rstrip('/')}/mapping-{uuid.uuid4().hex}"
    write_json_doc(mapping, path)
    return read_json_doc(spark, path, mapping.schema, multi_line=False)


_RAW = "CASE WHEN json_valid(value) THEN json_extract_string(value, '$.properties.\"{k}\"') END"


def _raw_sql(version: str) -> str:
    cols = ", ".join(f"{_RAW.format(k=c)} AS {c}" for c in ("recipe_id", "recipe_url", "recipe_name", "recipe_author"))
    names = ", ".join(f"'{e}'" for e in RECONCILE_EVENTS)
    return f"""SELECT recipe_url, arg_min(recipe_id, o) AS recipe_id, arg_min(recipe_name, o) AS recipe_name, arg_min(recipe_author, o) AS recipe_author
FROM (SELECT *, (ts, recipe_id, recipe_name, recipe_author) AS o FROM (
  SELECT {cols}, TRY_CAST({_RAW.format(k="time")} AS DOUBLE) AS ts,
         CASE WHEN json_valid(value) THEN json_extract_string(value, '$.event') END AS event
  FROM ({X.sql_raw_event_lines(version)})) WHERE event IN ({names}) AND recipe_id <> '' AND recipe_url <> '')
GROUP BY recipe_url"""


@query("T04_from_raw_lines", canon_sql(f"""
WITH f1 AS ({_raw_sql('v1')}), f2 AS ({_raw_sql('v2')})
SELECT recipe_url, f1.recipe_id AS v1_recipe_id, f2.recipe_id AS v2_recipe_id,
       coalesce(CASE WHEN f1.recipe_name <> '' THEN f1.recipe_name END, f2.recipe_name) AS recipe_name,
       coalesce(CASE WHEN f1.recipe_author <> '' THEN f1.recipe_author END, f2.recipe_author) AS recipe_author,
       f1.recipe_name IS NOT DISTINCT FROM f2.recipe_name AS are_identical
FROM f1 JOIN f2 USING (recipe_url)""", {}))
def t04_from_raw_lines(spark, sf_dir):
    """The item mapping from raw JSON lines, in an order that depends on the events alone."""
    from plateau.sources.events import parse_event_lines
    e = [R.extract_recipe_events(parse_event_lines(X.raw_event_lines(spark, sf_dir, v)), v) for v in ("v1", "v2")]
    return reconcile_items(*e, order=R.EVENT_ORDER)[0]
