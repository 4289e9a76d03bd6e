"""Run every registered query against its DuckDB oracle and print a report.

python -m tests.oracle_report [sf_dir] [name ...]
"""
from __future__ import annotations

import sys
import time

from tests import compare as C


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from stratus.session import get_session

    spark = get_session("local[8]", 8)
    con = C.duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            spdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(spdf)} rows ({ts:.2f}s) [no oracle]")
            continue
        try:
            opdf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: oracle error {str(e)[:300]}")
            bad += 1
            continue
        probs = C.compare(spdf, opdf)
        strict = C.compare_strict(spdf, opdf)
        sd = {c: str(t) for c, t in spdf.dtypes.items()}
        od = {c: str(t) for c, t in opdf.dtypes.items()}
        if sd != od:
            diff = {c: (sd.get(c), od.get(c)) for c in set(sd) | set(od) if sd.get(c) != od.get(c)}
            strict = strict + [f"dtypes {diff}"]
        if probs:
            bad += 1
            print(f"FAIL {name}: {probs}")
        else:
            print(f"OK   {name}: {len(spdf)} rows ({ts:.2f}s){'' if not strict else ' [strict: ' + strict[0][:200] + ']'}")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
