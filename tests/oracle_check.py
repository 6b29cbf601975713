"""Run registered queries and their SQL twins side by side and compare all values.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if v.__class__.__name__ == "Timestamp":
        v = v.to_pydatetime()
    return str(v)


def compare(spark, con, sf: str, name: str, query, sql: str) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(_cell(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    index = [names.index(c) for c in columns]
    want = sorted(tuple(_cell(r[i]) for i in index) for r in cur.fetchall())
    if got == want:
        return None
    extra, missing = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    return f"{len(got)} rows != {len(want)}; only here {extra}; only there {missing}"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, bad = duck(sf), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if name not in sqls:
            continue  # no SQL can express it; its tests hold it against a plain version
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf, name, query, sqls[name]) if name in sqls else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.1f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
