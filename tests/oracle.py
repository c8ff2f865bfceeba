"""Runs queries beside their SQL in DuckDB and compares the rows, whatever their order."""

import math
import os
import sys

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    if type(x).__name__ == "Decimal":
        return plain(float(x))
    if isinstance(x, bool) or x is None or isinstance(x, (int, str)):
        return x
    if hasattr(x, "tzinfo") and getattr(x, "tzinfo", None) is not None:
        return str(x.replace(tzinfo=None))
    return str(x)


def compare(spark, query, sql, sf_dir):
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}/*.parquet')" if os.path.isdir(p) else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    if sorted(cols) != names:
        return f"columns {names} against {sorted(cols)}"
    at = [cols.index(c) for c in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}; e.g. {got[:2]} {want[:2]}"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"{names}: {a} against {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    s = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    q, o = e.queries(), e.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or sorted(o):
        try:
            said = compare(s, q[name], o[name], f"/root/testdata/{sys.argv[1]}")
        except Exception as x:  # noqa: BLE001  reported below
            said = f"{type(x).__name__}: {str(x)[:900]}"
        bad += said is not None
        if said:
            print("DIFFERS", name, said, flush=True)
    print(f"{len(sys.argv[2:] or o) - bad} equal, {bad} not")
