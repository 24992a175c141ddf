import os

import pytest

import __spark_entry__ as entry
from textloom.plans import catalogue, records  # noqa: F401  records adds to the catalogue

SF = "/root/testdata/sf0.001"


def test_registry():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and set(catalogue.QUERIES) <= set(q)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry_and_oracles(spark):
    duckdb = pytest.importorskip("duckdb")
    assert entry.entry(spark).count() == 200
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    canon = lambda rows, cols: sorted(str([r[i] for i in sorted(range(len(cols)), key=cols.__getitem__)]) for r in rows)
    for name, sql in catalogue.SQL.items():
        df, r = catalogue.QUERIES[name](spark, SF), c.sql(sql)
        assert sorted(df.columns) == sorted(r.columns), name
        assert canon(df.collect(), df.columns) == canon(r.fetchall(), r.columns), name
