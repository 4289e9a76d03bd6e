"""Randomised parity with the source system's engines: DuckDB ROUND and pandas to_numeric."""
import duckdb
import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from stratus.functions import duck_round, to_number


def test_duck_round_matches_duckdb(spark):
    rng = np.random.default_rng(11)
    xs = np.concatenate([
        rng.uniform(-1000, 1000, 3000),
        np.round(rng.uniform(0, 100, 2000), 3),  # many exact-looking ties like 0.285
        np.arange(0, 10, 0.005),
    ]).tolist()
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in df.select(duck_round("x", 2)).collect()]
    con = duckdb.connect()
    con.register("t", pd.DataFrame({"x": xs}))
    want = [r[0] for r in con.execute("SELECT ROUND(x, 2) FROM t").fetchall()]
    assert got == want


# Readings have at most 15 significant digits; beyond that pandas' fast parser
# can be 1 ulp off the correctly rounded value Spark (Java) produces.
_number = st.one_of(
    st.floats(min_value=-1e9, max_value=1e9, allow_nan=False).map(lambda f: repr(round(f, 6))),
    st.integers(-10**9, 10**9).map(str),
    st.sampled_from(["1e3", "-2.5E-2", ".5", "5.", " 7 ", "+3", "inf", "-inf"]),
)
_junk = st.sampled_from(["<Samp", "Down", "RS232", "Zero", "Calib", "InVld", "NoData", "NaN", "", " ", "1d",
                         "0x10", "1,5", "abc", "--1", "1e", "e3"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(_number, _junk), min_size=50, max_size=200))
def test_to_number_matches_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(to_number("x")).collect()]
    want = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce").astype(float)
    want = [None if np.isnan(w) else float(w) for w in want]
    assert got == want
