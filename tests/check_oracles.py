"""Compare registered queries with their SQL: ``python tests/check_oracles.py SF_DIR [NAME...]``."""

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 9) if isinstance(v, float) and math.isfinite(v) else v
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    import duckdb

    db = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(p)[: -len(".parquet")]
        db.execute(f"create view {name} as select * from read_parquet('{p}/*.parquet' )" if os.path.isdir(p) else f"create view {name} as select * from read_parquet('{p}')")
    return db


def compare(spark, db, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    found = db.execute(sql)
    want = rows_of([c[0] for c in found.description], found.fetchall())
    return got, want


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    db, oracles = connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            if name in oracles:
                got, want = compare(spark, db, sf_dir, query, oracles[name])
                said = "ok" if got == want else f"DIFFERS {got[0]} {len(got[1])} {want[0]} {len(want[1])} {got[1][:2]} {want[1][:2]}"
                print(name, said, len(got[1]), f"{time.time() - t:.1f}", flush=True)
            else:
                print(name, "rows only", query(spark, sf_dir).count(), f"{time.time() - t:.1f}", flush=True)
        except Exception as e:
            print(name, "FAILED", str(e)[:1500], flush=True)
