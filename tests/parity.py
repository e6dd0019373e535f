"""Run registered queries against their SQL in DuckDB and compare whole results."""

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float) and not math.isnan(v):
        return round(v, 9)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """(row count, list of differences) of a Spark result and its SQL."""
    cur = con.execute(sql)
    want_cols, want = table([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = table(df.columns, df.collect())
    problems = []
    if want_cols != got_cols:
        problems.append(f"columns {got_cols} instead of {want_cols}")
    elif want != got:
        problems.append(f"only in Spark {list((got - want).items())[:3]}, only in SQL {list((want - got).items())[:3]}")
        problems.append(f"rows {got.total()} instead of {want.total()}")
    return got.total(), problems


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry

    from logweir.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted or name not in entry.oracle_sql():
            continue
        started = time.time()
        try:
            rows, problems = compare(fn(spark, sf_dir), con, entry.oracle_sql()[name])
        except Exception as e:
            rows, problems = -1, [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={rows} {time.time() - started:.1f}s", *problems, flush=True)
    print("failed:", bad)
