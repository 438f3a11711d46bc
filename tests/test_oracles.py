"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from jobmill.plans.oracles import ORACLES
from jobmill.plans.registry import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
MODELS = {"lda_topics", "kmeans_cosine", "lang_open_set"}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(rows, order):
    fixed = [tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(fixed, key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = plain([tuple(r) for r in df.select(*columns).collect()], range(len(columns)))
    if name in MODELS:
        assert got
        return
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    assert got == plain(cursor.fetchall(), [names.index(c) for c in columns])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLES) == set(QUERIES) - MODELS
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
