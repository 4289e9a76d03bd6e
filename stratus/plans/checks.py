"""Plan inspection used by tests and the benchmark (read-only, via explain)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def plan_has(df: DataFrame, needle: str) -> bool:
    return needle in physical_plan(df)


def executed_scans(df: DataFrame) -> int:
    """Runs ``df`` and counts the file scans of the plan that ran; a reused exchange counts no scan."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0] if "== Final Plan ==" in text else text
    return final.count("FileScan")
