"""Run registered queries and their SQL side by side: columns, row count, values."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def check(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return bool(got) or "no rows", len(got), t1 - t0, 0.0
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    t2 = time.time()
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(cols)}", len(got), t1 - t0, t2 - t1
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a != b:
        only_a = [x for x in a if x not in set(b)][:3]
        only_b = [x for x in b if x not in set(a)][:3]
        return f"{len(a)} rows != {len(b)} rows\n   spark only {only_a}\n   sql only   {only_b}", len(got), t1 - t0, t2 - t1
    return True, len(got), t1 - t0, t2 - t1


if __name__ == "__main__":
    sys.path[:0] = ["/root/repo", "/tmp"]
    import __spark_entry__ as E
    from pyspark.sql import SparkSession

    sf = sys.argv[1]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in sys.argv[2:] or qs:
        try:
            ok, k, ts, td = check(spark, con, n, qs[n], sqls.get(n), sf)
        except Exception as e:  # noqa: BLE001
            ok, k, ts, td = f"{type(e).__name__}: {str(e)[:700]}", 0, 0, 0
        bad += ok is not True
        print(f"{'ok  ' if ok is True else 'BAD '} {n:34s} rows={k:<7d} spark={ts:6.2f}s sql={td:6.2f}s {'' if n in sqls else '(rows only)'} {'' if ok is True else ok}", flush=True)
    print("bad:", bad, "of", len(sys.argv[2:] or qs))
