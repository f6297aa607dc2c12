"""Run queries() against oracle_sql() at one scale and report differences."""
import sys, time, math
sys.path.insert(0, "/root/repo")
import duckdb
from pyspark.sql import SparkSession
import __spark_entry__ as e

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def main(sf, names):
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect(); con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    qs, sqls = e.queries(), e.oracle_sql()
    bad = []
    for name in sorted(qs):
        if names and not any(n == name or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            rows = [tuple(r) for r in df.collect()]
        except Exception as ex:
            print(f"FAIL  {name}: spark {str(ex)[:600]}"); bad.append(name); continue
        t1 = time.time()
        if name not in sqls:
            print(f"rows  {name}: {len(rows)} rows {t1-t0:.1f}s cols={df.columns}"); continue
        try:
            cur = con.execute(sqls[name]); cols = [d[0] for d in cur.description]; orows = cur.fetchall()
        except Exception as ex:
            print(f"FAIL  {name}: sql {str(ex)[:600]}"); bad.append(name); continue
        t2 = time.time()
        o = sorted(cols); s = sorted(df.columns)
        if o != s:
            print(f"FAIL  {name}: columns {s} vs {o}"); bad.append(name); continue
        si = [df.columns.index(c) for c in s]; oi = [cols.index(c) for c in o]
        a = sorted(tuple(str(norm(r[i])) for i in si) for r in rows)
        b = sorted(tuple(str(norm(r[i])) for i in oi) for r in orows)
        if a != b:
            bad.append(name)
            sa, sb = set(a), set(b)
            print(f"FAIL  {name}: {len(a)} vs {len(b)} rows; only spark {len(sa-sb)} only sql {len(sb-sa)}  {s}")
            for x in sorted(sa - sb)[:3]: print("   spark", str(x)[:700])
            for x in sorted(sb - sa)[:3]: print("   sql  ", str(x)[:700])
        else:
            print(f"ok    {name}: {len(a)} rows spark {t1-t0:.1f}s sql {t2-t1:.1f}s")
    print("BAD", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
