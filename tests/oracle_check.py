"""Compare registered queries with their oracle SQL on one data folder.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def kind(value) -> str:
    return type(value).__name__


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    have_cols = sorted(spark_df.columns)
    found = con.execute(sql)
    want_cols = [c[0] for c in found.description]
    if have_cols != sorted(want_cols):
        return f"columns {have_cols} against {sorted(want_cols)}"
    pick = [want_cols.index(c) for c in have_cols]
    text = lambda row: tuple(f"{kind(v)}:{v!r}" for v in row)
    want = sorted(text([r[i] for i in pick]) for r in found.fetchall())
    have = sorted(text(r) for r in spark_df.select(*have_cols).collect())
    if len(have) != len(want):
        return f"{len(have)} rows against {len(want)}"
    wrong = [(h, w) for h, w in zip(have, want) if h != w]
    if wrong:
        return f"{len(wrong)} of {len(have)} rows differ, first {wrong[0]} in {have_cols}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            oracle = entry.oracle_sql().get(name)
            result = compare(df, con, oracle) if oracle else f"no oracle, {df.count()} rows"
        except Exception as error:  # report and go on with the other queries
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        fine = result is None or result.startswith("no oracle")
        bad += not fine
        print(f"{'ok ' if fine else 'BAD'} {name} {time.time() - begin:.1f}s {result or ''}",
              flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
