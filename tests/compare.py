"""Run queries and their SQL side by side: python tests/compare.py sf_dir [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def same(spark, con, f, sql, sf):
    got = f(spark, sf)
    names = sorted(got.columns)
    a = sorted((tuple(norm(r[c]) for c in names) for r in got.collect()), key=repr)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == names, (sorted(cols), names)
    at = [cols.index(c) for c in names]
    b = sorted((tuple(norm(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    return a, b


def connect(sf):
    import duckdb

    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


if __name__ == "__main__":
    import __spark_entry__ as e
    from terminus.session import session

    sf, names = sys.argv[1], sys.argv[2:]
    spark, con = session("local[8]", 8), connect(sf)
    spark.sparkContext.setLogLevel("OFF")
    sql = e.oracle_sql()
    for name, f in e.queries().items():
        if names and not any(name.startswith(n) for n in names) or not names and (name.startswith("op") or name == "pipeline"):
            continue
        t = time.time()
        try:
            if name in sql:
                a, b = same(spark, con, f, sql[name], sf)
                print(name, "OK" if a == b else f"DIFFERS {len(a)} {len(b)} {[x for x in a if x not in b][:2]} {[x for x in b if x not in a][:2]}", len(a), round(time.time() - t, 1), flush=True)
            else:
                print(name, "rows", f(spark, sf).count(), round(time.time() - t, 1), flush=True)
        except Exception as x:
            print(name, "ERROR", str(x)[:300].replace("\n", " "), flush=True)
