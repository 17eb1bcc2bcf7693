"""Every registered query against its SQL twin, on the smallest given data."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from murmuration.plans.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
TABLES = "events documents labels conversations pages".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def canon(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return str(value)


def test_every_query_has_a_twin():
    from murmuration.plans.oracles import ORACLES

    assert set(ORACLES) == set(REGISTRY)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, sql, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in columns) for r in df.collect())
    cursor = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(tuple(canon(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    assert got == want and got


def test_nfkc_twin_notices_missing_normalisation(spark, sql):
    from murmuration.sources import given_tables

    plain = {r["post_id"]: r["content"] for r in given_tables.posts(spark, SF_DIR).collect()}
    wanted = dict(sql.execute(entry.oracle_sql()["nfkc"]).fetchall())
    assert sum(plain[i] != w for i, w in wanted.items()) >= len(plain) // 13
