"""Compare registered queries with their DuckDB SQL; also a script: python -m tests.oracle SF_DIR [NAME...]."""

from __future__ import annotations

import glob
import math
import os
import sys

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(map(_plain, value))
    return str(value) if value is not None and not isinstance(value, (int, bool, str)) else value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, sf_dir: str, name: str, query, sql: str) -> int:
    """Asserts equal names, types by family and rows; returns the number of rows."""
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        files = sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else [path]
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet({files!r})")
    got = con.execute(sql)
    columns = [d[0] for d in got.description]
    kinds = {d[0]: str(d[1]).upper() for d in got.description}
    theirs = rows(columns, got.fetchall())
    df = query(spark, sf_dir)
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(df.columns) == sorted(columns), (name, df.columns, columns)
    family = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    off = {c: (k, kinds[c]) for c, k in df.dtypes if k in family and family[k] != kinds[c] and kinds[c] != "STRING"}
    assert len(ours) == len(theirs), (name, len(ours), len(theirs))
    bad = next(((a, b) for a, b in zip(ours, theirs, strict=True) if a != b), None)
    assert bad is None, (name, bad)
    assert not off, (name, "types", off)
    return len(ours)


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or sorted(oracles):
        try:
            print(name, "ok", compare(spark, sys.argv[1], name, queries[name], oracles[name]), flush=True)
        except Exception as e:  # noqa: BLE001
            print(name, "FAIL", repr(e)[:1500], flush=True)
