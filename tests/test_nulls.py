"""Queries over tables with null keys, times and parts, against their SQL."""

import os

import duckdb
import pytest

from lectern.plans import registry
from tests.test_registry import SF, table

NULLS = {
    "events": "* REPLACE (CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS ts)",
    "documents": "* REPLACE (CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang END AS lang, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id END AS doc_id)",
    "customer": "* REPLACE (CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey END AS c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS c_name)",
}


@pytest.mark.parametrize("name", ["asof_cut", "run_detection", "batch_of_three", "merge_order"])
def test_null_keys_stay(name, spark, tmp_path):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t, columns in NULLS.items():
        c.execute(f"COPY (SELECT {columns} FROM read_parquet('{SF}/{t}.parquet')) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    got = registry.QUERIES[name](spark, str(tmp_path))
    columns = sorted(got.columns)
    want = c.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]})").fetchall()
    assert table(got.select(*columns).collect(), columns) == table(want, columns)
