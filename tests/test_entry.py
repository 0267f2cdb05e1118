import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def plain(row):
    return tuple(("nan" if math.isnan(v) else round(v, 9)) if isinstance(v, float) else str(v) if hasattr(v, "isoformat") else v for v in row)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, data, con, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    theirs = con.sql(SQL[name])
    assert sorted(theirs.columns) == columns
    a = Counter(plain(r) for r in df.select(*columns).collect())
    b = Counter(plain(r) for r in theirs.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert a == b


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("p1_", "p2_", "p5_")) and n not in SQL))
def test_query_runs(spark, data, name):
    rows = QUERIES[name](spark, data).collect()
    assert rows and len(set(rows)) == len(rows)


def test_flagship(spark, data):
    assert entry.entry(spark).columns == ["pixel_id", "max_drop", "date_drop", "dnbr"]
