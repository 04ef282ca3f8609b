"""A sample of registered queries against their DuckDB oracles at sf0.001 (the full set
runs with scripts/oracle_check.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, key, rows_of
from tests.conftest import SF

SAMPLE = ["A01_user_profiles", "T05_combined_events", "N01_negative_samples", "M02_ranking_metrics",
          "R01_recommend_top_n", "X03_tfidf_transform", "A19_user_features", "J03_map_item_ids"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF).toPandas()
    ddf = con.execute(E.oracle_sql()[name]).df()
    cols = sorted(sdf.columns)
    assert cols == sorted(ddf.columns)
    assert sorted(rows_of(sdf[cols]), key=key) == sorted(rows_of(ddf[cols]), key=key)


def test_every_query_has_callable_and_sql_is_text():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert all(isinstance(v, str) and v.strip() for v in o.values())
