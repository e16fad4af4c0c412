"""Compares a query with its SQL in DuckDB over the same Parquet files."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def compare(spark, name, query, sql, sf_dir):
    got = query(spark, sf_dir).toPandas()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    want = con.execute(sql).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns), name
    a, b = (x[columns].astype(str).sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b), name
    assert a.equals(b), f"{name}\n{a[(a != b).any(axis=1)].head()}\n{b[(a != b).any(axis=1)].head()}"
