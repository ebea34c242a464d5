"""Every linkage query against its SQL counterpart at the smallest scale."""

import importlib.util
from collections import Counter
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
spec = importlib.util.spec_from_file_location("entry_module", ROOT / "__spark_entry__.py")
entry_module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_module)

from namelink.catalog import QUERIES  # noqa: E402
from oracle.sql import ORACLES  # noqa: E402


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, tables, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = Counter(tuple(str(r[c]) for c in columns) for r in frame.collect())
    cursor = tables.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == Counter(tuple(str(r[i]) for i in order) for r in cursor.fetchall())
    assert got


def test_entry(spark):
    assert not entry_module.entry(spark).isEmpty()
