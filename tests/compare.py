"""Order-insensitive comparison of a Spark result with a DuckDB oracle result."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def rows_of(df: pd.DataFrame) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    df = df[cols]
    out = Counter()
    for rec in df.itertuples(index=False, name=None):
        out[tuple(_norm(v) for v in rec)] += 1
    return cols, out


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> list[str]:
    problems = []
    if len(spark_pdf) != len(oracle_pdf):
        problems.append(f"rows {len(spark_pdf)} != {len(oracle_pdf)}")
    sc, sr = rows_of(spark_pdf)
    oc, orr = rows_of(oracle_pdf)
    if sc != oc:
        problems.append(f"columns {sc} != {oc}")
        return problems
    if sr != orr:
        only_s = list((sr - orr).elements())[:3]
        only_o = list((orr - sr).elements())[:3]
        problems.append(f"values differ; spark-only {only_s}; oracle-only {only_o}")
    return problems


def _strict(v):
    v = _norm(v) if not isinstance(v, float) else (None if math.isnan(v) else v)
    return v


def compare_strict(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> list[str]:
    """Exact values (no float rounding): flags results a strict hash could reject."""
    def rows(df):
        cols = sorted(df.columns)
        return Counter(tuple(_strict(v) for v in rec) for rec in df[cols].itertuples(index=False, name=None))
    a, b = rows(spark_pdf), rows(oracle_pdf)
    if a != b:
        return [f"spark-only {list((a - b).elements())[:2]}; oracle-only {list((b - a).elements())[:2]}"]
    return []
