"""Compare a Spark result with DuckDB: same columns, same rows in any order."""

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (int, str)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v if isinstance(v, (int, str)) else (float(v) if type(v).__name__ == "Decimal" else str(v))


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, folder, name, fn, sql):
    df = fn(spark, folder)
    got_cols, got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_cols, want = rows([d[0] for d in res.description], res.fetchall())
    assert got_cols == want_cols, (name, got_cols, want_cols)
    assert len(got) == len(want), (name, len(got), len(want), [x for x in got if x not in want][:3] if len(got) < 5000 else "", [x for x in want if x not in got][:3] if len(want) < 5000 else "")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    types = [(a, b) for g, w in zip(got, want) for a, b in zip(g, w) if a is not None and b is not None and type(a) is not type(b)]
    assert not bad, (name, got_cols, len(bad), bad[:3])
    assert not types, (name, "types differ", types[:3])
    return len(got)


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from logloom.plans import catalog
    from logloom.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(folder), catalog.oracle_sql(), []
    for name, fn in catalog.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        t0 = time.time()
        try:
            if name in sqls:
                n = compare(spark, con, folder, name, fn, sqls[name])
            else:
                n = f"{len(fn(spark, folder).collect())} (rows only)"
            print(f"ok   {name:35s} {n} rows {time.time() - t0:.2f}s", flush=True)
        except Exception as e:
            failed.append(name)
            print(f"FAIL {name:35s} {str(e)[:1500]}", flush=True)
    print("failed:", failed)
