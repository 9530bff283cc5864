"""Run queries beside their oracles and compare: python -m checks.verify [sf] [name ...]"""

from __future__ import annotations

import sys
import time
import warnings

import duckdb
import pandas as pd

from checks import all_checks, all_sql
from inkmeter.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def compare(spark_df, duck_df) -> str:  # noqa: ANN001
    """'' when both hold the same rows, else what differs."""
    left, right = sorted(spark_df.columns), sorted(duck_df.columns)
    if left != right:
        return f"columns {left} != {right}"
    rows = [
        sorted((tuple(None if pd.isna(v) else v for v in r) for r in df[left].astype(object).itertuples(index=False)), key=repr)
        for df in (spark_df, duck_df)
    ]
    if len(rows[0]) != len(rows[1]):
        return f"rows {len(rows[0])} != {len(rows[1])}"
    bad = [(a, b) for a, b in zip(*rows, strict=True) if a != b]
    kinds = [f"{c}: {spark_df[c].dtype} {duck_df[c].dtype}" for c in left if spark_df[c].dtype.kind != duck_df[c].dtype.kind and len(spark_df)]
    note = f"  [types {kinds}]" if kinds else ""
    return (f"{len(bad)} rows differ, first {bad[0]}" if bad else "") + note


def main() -> int:
    warnings.simplefilter("ignore")
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    db, checks, sql = connect(sf_dir), all_checks(), all_sql()
    names = sys.argv[2:] or list(checks)
    failed = 0
    for name in names:
        start = time.time()
        try:
            got = checks[name](spark, sf_dir).toPandas()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark {str(exc)[:600]}", flush=True)
            failed += 1
            continue
        took = time.time() - start
        if name not in sql:
            print(f"rows {name}: {len(got)} ({took:.1f}s)", flush=True)
            continue
        start = time.time()
        try:
            want = db.sql(sql[name]).df()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb {str(exc)[:600]}", flush=True)
            failed += 1
            continue
        duck = time.time() - start
        why = compare(got, want)
        bad = bool(why) and not why.startswith("  [")
        failed += bad
        print(f"{'FAIL' if bad else 'ok'} {name}: {len(got)} rows, spark {took:.1f}s duck {duck:.1f}s {why[:900]}", flush=True)
    print(f"{len(names)} checked, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
