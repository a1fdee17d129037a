"""Every query of the core runs on the smallest tables, and agrees with its SQL."""

from collections import Counter
from pathlib import Path

import pytest

from subloom.plans import catalogue

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="the test tables aren't here")


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def key(row):
    return tuple(repr(round(x, 9) if isinstance(x, float) else sorted(x.items()) if isinstance(x, dict) else x) for x in row)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    df = catalogue.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    got = Counter(key(r) for r in df.select(*[df[f"`{c}`"] for c in cols]).collect())
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        return
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    assert got == Counter(key([r[names.index(c)] for c in cols]) for r in rel.fetchall())


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
