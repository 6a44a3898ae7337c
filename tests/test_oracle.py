"""A representative set of registered queries against their DuckDB twins at sf0.001
(the full set runs with tools/check_oracle.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF
from featurelane.sources.tables import TABLES

KEYS = ["history_user_item", "history_multi_unpivot", "activity_split", "array_encode", "fat_table",
        "multivalue_clean", "entity_unescape", "box_stats", "pooling_weighted", "roc_auc", "series_compare",
        "stream_vocab"]


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return "NULL" if v is None else str(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), ocols)
