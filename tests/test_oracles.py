"""Every registered query of the engine against its SQL, on the smallest tables."""

import os

import pytest

from fairground import queries, queries_landed, queries_matching, queries_state  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return None if value != value else round(value, 6)
    return value if value is None or isinstance(value, (int, bool, str)) else str(value)


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


@pytest.fixture(scope="module")
def db():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, db, name):
    frame = queries.QUERIES[name](spark, SF)
    got = ordered(frame.select(*sorted(frame.columns)).collect())
    if name not in queries.ORACLE_SQL:
        assert len(frame.columns) == len(set(frame.columns))
        return
    cursor = db.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    at = sorted(range(len(names)), key=lambda i: names[i])
    assert got == ordered([tuple(r[i] for i in at) for r in cursor.fetchall()])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
