"""Run queries beside their SQL on the test tables: ``python tests/oracle.py [sf] [name ...]``."""

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(x):
    if x is None or (isinstance(x, float) and math.isnan(x)) or str(x) in ("<NA>", "NaT"):
        return "NULL"
    if isinstance(x, bool):
        return str(int(x))
    if isinstance(x, (int, float)) or type(x).__module__ == "numpy":
        return repr(float(x)) if float(x) != int_or_none(x) else str(int(x))
    return str(x)


def int_or_none(x):
    return int(x) if math.isfinite(float(x)) else None


def compare(spark_df, con, sql):
    """None when equal, else a text saying how the results differ."""
    a, b = spark_df.toPandas(), con.execute(sql).df()
    cols = sorted(a.columns)
    if cols != sorted(b.columns):
        return f"columns {cols} / {sorted(b.columns)}"
    kinds = [(c, a[c].dtype.kind, b[c].dtype.kind) for c in cols if a[c].dtype.kind != b[c].dtype.kind and len(a)
             and not (a[c].hasnans and {a[c].dtype.kind, b[c].dtype.kind} == {"f", "i"})]  # whole numbers with nulls are floats on one side
    rows = [sorted(tuple(norm(x) for x in r) for r in d[cols].astype(object).itertuples(index=False)) for d in (a, b)]
    if len(rows[0]) != len(rows[1]):
        return f"rows {len(rows[0])} / {len(rows[1])}; only spark {[r for r in rows[0][:3]]}; only sql {[r for r in rows[1][:3]]}"
    bad = [(x, y) for x, y in zip(*rows) if x != y]
    if bad:
        return f"{len(bad)} of {len(rows[0])} rows differ {cols}: {bad[0]}"
    if kinds:
        return f"kinds differ: {kinds}"
    return None


if __name__ == "__main__":
    from retailflow.session import build_session
    import __spark_entry__ as e
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    d = f"/root/testdata/sf{sf}"
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, qs = connect(d), e.oracle_sql(), e.queries()
    names = sys.argv[2:] or list(qs)
    good = 0
    for n in names:
        t0 = time.time()
        try:
            if n in sql:
                msg = compare(qs[n](spark, d), con, sql[n])
            else:
                msg = f"no sql, {qs[n](spark, d).count()} rows"
        except Exception as x:  # noqa: BLE001
            msg = f"{type(x).__name__}: {str(x)[:700]}"
        rows = ""
        if msg is None and n in sql:
            c = con.execute(f"SELECT count(*) FROM ({sql[n]})").fetchone()[0]
            rows = f"{c} rows" + (" EMPTY" if c == 0 else "")
        good += msg is None
        print(f"{n:28s} {'ok ' + rows if msg is None else 'FAIL ' + msg}  {time.time() - t0:.1f}s", flush=True)
    print(f"{good}/{len(names)}")
