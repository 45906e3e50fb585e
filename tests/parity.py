"""Run registered queries on Spark and DuckDB over the same tables and compare."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def make_spark(cpus: str = "8"):
    from pyspark.sql import SparkSession
    return (SparkSession.builder.master(f"local[{cpus}]").appName("sidweave-check")
            .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.extraJavaOptions", "-Duser.timezone=UTC")
            .config("spark.ui.showConsoleProgress", "false").getOrCreate())


def make_duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(type_text: str) -> str:
    t = type_text.lower()
    for k, names in {"int": ("bigint", "int", "integer", "smallint", "tinyint", "hugeint", "ubigint"),
                     "double": ("double", "float"), "string": ("string", "varchar"),
                     "boolean": ("boolean",), "timestamp": ("timestamp",)}.items():
        if t in names:
            return {"int": t if t in ("hugeint", "ubigint") else "int"}.get(k, k)
    return t


def compare(spark, con, fn, sql, sf_dir) -> str:
    """Empty string when equal, else the reason."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    ours = df.select(*[f"`{c}`" for c in cols]).collect()
    if sql is None:
        return "" if ours else "no rows"
    cur = con.execute(sql)
    theirs_cols = [d[0] for d in cur.description]
    if sorted(theirs_cols) != cols:
        return f"columns {cols} vs {sorted(theirs_cols)}"
    raw = cur.fetchall()
    at = [theirs_cols.index(c) for c in cols]
    st = {c: _kind(t) for c, t in df.dtypes}
    dt = {d[0]: _kind(str(d[1])) for d in cur.description}
    diff = [(c, st[c], dt[c]) for c in cols if st[c] != dt[c]]
    if diff:
        return f"types {diff}"
    a = sorted(map(repr, (tuple(r) for r in ours)))
    b = sorted(repr(tuple(r[i] for i in at)) for r in raw)
    if not a:
        return "no rows"
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}; first {a[:1]} vs {b[:1]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)}/{len(a)} differ: {str(bad[0][0])[:700]} || {str(bad[0][1])[:700]}" if bad else ""


def main(argv):
    import __spark_entry__ as E
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = list(E.queries())
    if argv:
        names = [n for n in names if any(n == a or n.startswith(a + "_") or (a.endswith("*") and n.startswith(a[:-1]))
                                         for a in argv)]
    spark, con = make_spark(), make_duck(sf)
    if os.environ.get("FORCE_SHUFFLE"):  # take the salted paths a large cluster would take
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for n in names:
        t = time.time()
        try:
            why = compare(spark, con, E.queries()[n], E.oracle_sql().get(n), sf)
        except Exception as e:  # noqa: BLE001
            why = f"{type(e).__name__}: {str(e)[:900]}"
        bad += bool(why)
        tag = "FAIL" if why else ("ok  " if n in E.oracle_sql() else "rows")
        print(f"{tag} {n} {time.time() - t:.1f}s {why}", flush=True)
    print(f"{len(names) - bad}/{len(names)} good")


if __name__ == "__main__":
    main(sys.argv[1:])
