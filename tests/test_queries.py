"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from spanloom.plans import registry


def plain(v):
    """A value in a form that both engines share."""
    if v is None or v != v:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, list):
        return [plain(x) for x in v]
    return str(v)


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(str([plain(x) for x in r]) for r in zip(*(table.column(c).to_pylist() for c in names)))


@pytest.fixture(scope="module")
def con(sf_dir):
    out = duckdb.connect()
    out.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        out.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return out


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, con, name):
    got = registry.QUERIES[name](spark, sf_dir).toArrow()
    if name in registry.ORACLE_SQL:
        assert rows(got) == rows(con.execute(registry.ORACLE_SQL[name]).to_arrow_table())


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[:2] == ["user_id", "session"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
