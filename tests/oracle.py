"""A Spark result beside DuckDB's answer to the same question."""

import glob
import os

import duckdb


def connect(folder):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in glob.glob(f"{folder}/*.parquet"):
        src = f + ("/*.parquet" if os.path.isdir(f) else "")
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{src}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows(table, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in table), key=repr)


def same(df, sql, folder):
    answer = connect(folder).execute(sql)
    columns = [c[0] for c in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(answer.fetchall(), columns)
