"""The subpackage's queries against their SQL on the smallest tables."""

import duckdb
import pytest

from jobmill.llm.oracles import ORACLES
from jobmill.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, folder, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    got = QUERIES[name](spark, folder).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, cursor.fetchall()))


def test_all_are_registered():
    found = {n.split("_")[0] for n in QUERIES}
    assert found == {f"op{i}" for i in range(1, 14)}
