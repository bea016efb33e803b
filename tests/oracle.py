"""Side-by-side check of a Spark query against its DuckDB SQL twin:
row count, column names and an order-insensitive comparison of values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from keelson.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(float(v)))
    try:
        import numpy as np
        if isinstance(v, np.floating):
            return (1, repr(float(v)))
        if isinstance(v, np.integer):
            return (1, repr(int(v)))
    except ImportError:
        pass
    if isinstance(v, bool):
        return (1, repr(v))
    if isinstance(v, int):
        return (1, repr(int(v)))
    return (1, str(v))


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(v) for v in row) for row in df[cols].itertuples(index=False, name=None)]
    return sorted(out)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = rows_of(spark_pdf), rows_of(duck_pdf)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {bad}"
    return True, "ok"
