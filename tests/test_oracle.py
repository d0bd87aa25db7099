"""Every core query against its SQL on the driver's smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from quirespark.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v if isinstance(v, (int, str, bool, type(None))) else str(v)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    rel = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    mine = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    at = [rel.columns.index(c) for c in cols]
    theirs = Counter(tuple(_norm(r[k]) for k in at) for r in rel.fetchall())
    assert mine == theirs


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_stands_without_llm():
    import subprocess
    import sys

    code = "import sys; sys.modules['quirespark.llm'] = None\nimport __spark_entry__ as e\nassert e.queries() and not any(k[0] == 'p' and k[1].isdigit() for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parent.parent)
