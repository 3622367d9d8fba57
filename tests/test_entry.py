import __spark_entry__ as entry


def test_names():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 35
    assert "bm25_name_topk" in queries


def test_columns_agree(spark):
    import os

    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    for name in ("bm25_name_topk", "seen_state", "macro_f05"):
        got = entry.queries()[name](spark, folder)
        cur = con.execute(entry.oracle_sql()[name])
        assert sorted(got.columns) == sorted(c[0] for c in cur.description)
        assert got.count() == len(cur.fetchall())
