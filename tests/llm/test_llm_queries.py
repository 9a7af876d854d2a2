"""The queries of this package with a DuckDB counterpart give the same rows on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from quire.llm import queries

SQL, ALL = queries.oracle_sql(), queries.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, data, name):
    if name.startswith("p7") and not Path("/opt/tokenizers").exists():
        pytest.skip("no vocabulary here")
    got = ALL[name](spark, data).toPandas()
    c = duckdb.connect()
    for f in Path(data).iterdir():
        c.execute(f"create view {f.stem} as select * from '{f}'")
    want = c.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(want) > 0
    rows = lambda df: sorted(tuple(map(str, r)) for r in df[sorted(df.columns)].itertuples(index=False))
    assert rows(got) == rows(want)
