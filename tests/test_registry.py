"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from lectern.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


LARGER = "/root/testdata/sf0.01"
#: Queries whose slices, buckets and parts the smallest tables hardly fill.
ON_LARGER = "cooldown_events dedup_ttl_events alert_emails_by_day interval_fix asof_cut run_detection alias_antijoin surrogate_ids roster_match_contains keyword_hits".split()


def connected(folder):
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def duck():
    return connected(SF)


@pytest.fixture(scope="module")
def larger():
    return connected(LARGER)


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def table(rows, columns):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr), columns


def equal(name, spark, duck, folder):
    got = registry.QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    expected = duck.execute(registry.ORACLES[name])
    assert columns == sorted(d[0] for d in expected.description)
    want = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({registry.ORACLES[name]})").fetchall()
    rows = got.select(*[f"`{c}`" for c in columns]).collect()
    assert table(rows, columns) == table(want, columns)
    assert rows


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(name, spark, duck):
    equal(name, spark, duck, SF)


@pytest.mark.parametrize("name", ON_LARGER)
def test_query_equals_sql_on_larger_tables(name, spark, larger):
    equal(name, spark, larger, LARGER)
