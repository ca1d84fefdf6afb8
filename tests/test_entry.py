import os

import pytest

import __spark_entry__ as entry_module

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_sql_and_names_match():
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) >= 100
    assert set(entry_module.LLM_QUERIES) <= set(queries)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
def test_flagship(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["source", "articles", "with_markup"]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
@pytest.mark.parametrize("name", ["gate_articles", "corpus_update", "runs_anomaly", "quality_issues", "page_links"])
def test_sql_agrees(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f[:-8]} as select * from '{SMALL}/{f}'")
    want = con.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in want.description]
    rows = sorted(repr(tuple(r)) for r in want.fetchall())
    got = entry_module.queries()[name](spark, SMALL).select(*names)
    assert sorted(repr(tuple(r)) for r in got.collect()) == rows
