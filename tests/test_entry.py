import __spark_entry__ as entry


def test_registry_consistent():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 30


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 20
    assert df.columns == ["position", "id", "rank"]
    assert [r.position for r in rows] == sorted(r.position for r in rows)
