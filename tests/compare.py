"""Run registered queries beside their SQL and compare all rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        v = float(v)
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def oracle(sql: str, sf_dir: str):
    db = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        db.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    got = db.execute(sql)
    names = [d[0] for d in got.description]
    return sorted(names), rows_of(names, got.fetchall())


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def differences(name: str, spark, sf_dir: str, queries: dict, sql: dict) -> str:
    names, rows = spark_rows(queries[name](spark, sf_dir))
    want_names, want = oracle(sql[name], sf_dir)
    if names != want_names:
        return f"columns {names} and {want_names}"
    if rows != want:
        odd = [(a, b) for a, b in zip(rows, want, strict=False) if a != b][:2]
        return f"{len(rows)} and {len(want)} rows; first differing: {odd}"
    return ""
