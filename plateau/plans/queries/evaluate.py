"""Ranking-metric queries (M02-M04, W09) on the event-derived evaluation rows (ties on
an integer score grid, graded labels 0/1/2/5)."""

from __future__ import annotations

from plateau.operators import evaluate as EV
from plateau.plans.canonical import canon_sql
from plateau.plans.registry import query
from plateau.sources import fixtures as X


def _ndcg_sql(k: int) -> str:
    """CTEs u{k}, r{k}x, d{k}, i{k}, n{k} over an ``e`` CTE of evaluation rows."""
    return f"""
u{k} AS (SELECT user_id FROM e GROUP BY user_id HAVING count(*) >= 2),
r{k}x AS (SELECT e.*, rank() OVER (PARTITION BY user_id ORDER BY y_score DESC) AS rk,
             count(*) OVER (PARTITION BY user_id, y_score) AS c FROM e),
d{k} AS (SELECT user_id, sum(y_true * list_sum(list_transform(range(rk, least(rk + c - 1, {k}) + 1),
                                                      lambda p: 1.0 / log2(p + 1))) / c) AS dcg
      FROM r{k}x WHERE rk <= {k} GROUP BY user_id),
i{k} AS (SELECT user_id, sum(y_true / log2(pos + 1)) AS idcg FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY y_true DESC) AS pos FROM e) WHERE pos <= {k}
      GROUP BY user_id),
n{k} AS (SELECT u{k}.user_id, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0.0 END AS ndcg_{k}
         FROM u{k} LEFT JOIN d{k} USING (user_id) LEFT JOIN i{k} USING (user_id))
"""


_E = "WITH e AS (" + X.SQL_EVAL_INPUT + "),"


def _recall_sql(k: int) -> str:
    return f"""
t{k} AS (SELECT user_id, sum(y_true) AS tot FROM e GROUP BY user_id HAVING count(*) >= 2 AND sum(y_true) > 0),
h{k} AS (SELECT user_id, sum(y_true) AS hit FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY y_score DESC, row_id) AS pos FROM e)
        WHERE pos <= {k} GROUP BY user_id),
r{k} AS (SELECT user_id, hit / tot AS recall_{k} FROM t{k} LEFT JOIN h{k} USING (user_id))
"""


@query("M02_ndcg_per_user", canon_sql(_E + _ndcg_sql(10) + "SELECT * FROM n10", {"ndcg_10": "d"}))
def m02_ndcg_per_user(spark, sf_dir):
    """Per-user NDCG@10 with tie-averaged DCG."""
    return EV.ndcg_per_user(X.eval_input(spark, sf_dir), 10)


@query("M03_recall_per_user", canon_sql(_E + _recall_sql(5) + "SELECT * FROM r5", {"recall_5": "d"}))
def m03_recall_per_user(spark, sf_dir):
    return EV.recall_per_user(X.eval_input(spark, sf_dir), 5)


@query("M02_ranking_metrics", canon_sql(_E + _ndcg_sql(5) + "," + _ndcg_sql(10) + "," + _recall_sql(5) + ","
                                        + _recall_sql(10) + """
SELECT (SELECT avg(ndcg_5) FROM n5) AS ndcg_5, (SELECT avg(recall_5) FROM r5) AS recall_5,
       (SELECT avg(ndcg_10) FROM n10) AS ndcg_10, (SELECT avg(recall_10) FROM r10) AS recall_10,
       (SELECT count(*) FROM n5) AS users_evaluated""",
                                        {"ndcg_5": "d", "recall_5": "d", "ndcg_10": "d", "recall_10": "d",
                                         "users_evaluated": "i"}))
def m02_ranking_metrics(spark, sf_dir):
    """Mean NDCG@5/@10, recall@5/@10 and users evaluated."""
    return EV.ranking_metrics(X.eval_input(spark, sf_dir), (5, 10))


@query("M04_rank_correlation", canon_sql(f"""
WITH e AS ({X.SQL_EVAL_INPUT}),
ry AS (SELECT y_true, (count(*) OVER (ORDER BY y_true RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
                      - (count(*) OVER (PARTITION BY y_true) - 1) / 2.0 AS r_y FROM e),
rs AS (SELECT y_score, (count(*) OVER (ORDER BY y_score RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
                       - (count(*) OVER (PARTITION BY y_score) - 1) / 2.0 AS r_s FROM e),
ay AS (SELECT DISTINCT y_true, r_y FROM ry), as_ AS (SELECT DISTINCT y_score, r_s FROM rs)
SELECT corr(r_y, r_s) AS spearman_correlation, corr(e.y_true, e.y_score) AS pearson_correlation
FROM e JOIN ay USING (y_true) JOIN as_ USING (y_score)
""", {"spearman_correlation": "d", "pearson_correlation": "d"}))
def m04_rank_correlation(spark, sf_dir):
    return EV.rank_correlation(X.eval_input(spark, sf_dir))
