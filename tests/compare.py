"""Run a query and its SQL on the driver's tables and compare the rows."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "~"
        if isinstance(v, float):  # a column of whole numbers with nulls may come as floats
            return str(int(v)) if v == int(v) else f"{v:.6f}"
        return str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(v) for v in r) for r in frame.itertuples(index=False))


def same(spark, con, query, sql, sf_dir):
    got, want = query(spark, sf_dir).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
