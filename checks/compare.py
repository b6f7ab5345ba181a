"""Run registered queries in Spark and DuckDB and compare the rows.

``python -m checks.compare <sf_dir> [name ...]``
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_numeric_dtype(df[c]) or pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype("float64") + 0.0
        else:
            df[c] = df[c].astype("object").where(df[c].notna(), None)
    return df.sort_values(list(df.columns), na_position="last", kind="stable").reset_index(drop=True)


def differences(spark_df: DataFrame, duck_df: pd.DataFrame) -> str | None:
    """None if both hold the same rows, else what differs."""
    ours, theirs = _normal(spark_df.toPandas()), _normal(duck_df)
    if list(ours.columns) != list(theirs.columns):
        return f"columns {list(ours.columns)} against {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for c in ours.columns:
        a, b = ours[c], theirs[c]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            i = int((~same).to_numpy().argmax())
            return f"column {c}: {int((~same).sum())} of {len(a)} differ, first {a[i]!r} against {b[i]!r}\n{ours.iloc[i].to_dict()}\n{theirs.iloc[i].to_dict()}"
    return None


def main() -> int:
    from checks import registry
    from verdigrid.session import build_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    registry.load()
    spark: SparkSession = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                             "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, fn in registry.QUERIES.items():
        if wanted and name not in wanted:
            continue
        try:
            start = time.time()
            df = fn(spark, sf)
            if name in registry.ORACLES:
                found = differences(df, con.execute(registry.ORACLES[name]).df())
                rows = ""
            else:
                found, rows = None, f" rows={df.count()} (no SQL)"
            print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s{rows} {found or ''}", flush=True)
            bad += found is not None
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name} {type(e).__name__}: {str(e)[:600]}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
