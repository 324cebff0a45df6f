"""Every registered query against its check SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata/sf0.001")
TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
         "BOOLEAN": "boolean"}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12)
    return a == b


@pytest.mark.parametrize("name", sorted(q for q in contract.oracle_sql() if q.startswith("q_")))
def test_query_equals_its_sql(spark, database, name):
    df = contract.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = in_order(map(tuple, df.select(*columns).collect()))
    cursor = database.execute(contract.oracle_sql()[name])
    described = {d[0]: TYPES[str(d[1])] for d in cursor.description}
    order = [list(described).index(c) for c in columns]
    want = in_order(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert described == dict(df.dtypes)
    assert len(got) == len(want) > 0
    assert all(same(a, b) for g, w in zip(got, want) for a, b in zip(g, w))


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
