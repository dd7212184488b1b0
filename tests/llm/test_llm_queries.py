"""The queries of this subpackage that have SQL, against it, on the smallest tables."""

from pathlib import Path

import pytest

from corpusloom.llm.queries import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    found = c.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert sorted(tuple(r[k] for k in columns) for r in df.collect()) == sorted(tuple(r[names.index(k)] for k in columns) for r in found.fetchall())
