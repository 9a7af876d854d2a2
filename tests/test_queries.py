"""Every query with a DuckDB counterpart gives the same rows on the smallest tables; the others run."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SQL, ALL = entry.catalogue.oracle_sql(), entry.catalogue.queries()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v) or str(v) in ("<NA>", "nan", "NaT"):
        return None
    if isinstance(v, bool) or str(type(v)) == "<class 'numpy.bool_'>":
        return bool(v)
    if hasattr(v, "__iter__") and not isinstance(v, str | dict):
        return [plain(x) for x in v]
    return round(float(v), 6) if isinstance(v, int | float) or hasattr(v, "dtype") else v


def rows(df):
    return sorted(repr([plain(v) for v in r]) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, data, name):
    got = ALL[name](spark, data).toPandas()
    if name not in SQL:
        return
    c = duckdb.connect()
    for f in Path(data).iterdir():
        c.execute(f"create view {f.stem} as select * from '{f}'")
    want = c.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark, data):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
