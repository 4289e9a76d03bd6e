"""Command line for the end-to-end jobs.

    python -m stratus stage-wind  RAW_DIR STAGED_DIR
    python -m stratus stage-air   RAW_DIR STAGED_DIR
    python -m stratus normalise   STAGED_DIR NORMALISED_DIR
    python -m stratus load        NORMALISED_DIR WAREHOUSE_DIR
    python -m stratus verify      WAREHOUSE_DIR        (exit status 1 when integrity fails)
    python -m stratus dq          WAREHOUSE_DIR        (prints every report section)

The session comes from the environment (``spark-submit`` options or
``SPARK_*`` settings); ``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys

from stratus import jobs
from stratus.session import get_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="stratus")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    for name, args in [
        ("stage-wind", ["raw_dir", "staged_dir"]),
        ("stage-air", ["raw_dir", "staged_dir"]),
        ("normalise", ["staged_dir", "normalised_dir"]),
        ("load", ["normalised_dir", "warehouse_dir"]),
        ("verify", ["warehouse_dir"]),
        ("dq", ["warehouse_dir"]),
    ]:
        sp = sub.add_parser(name)
        for a in args:
            sp.add_argument(a)
    ns = p.parse_args(argv)
    spark = get_session(ns.master)

    if ns.cmd == "stage-wind":
        jobs.stage_wind_files(spark, ns.raw_dir, ns.staged_dir)
    elif ns.cmd == "stage-air":
        jobs.stage_air_archives(spark, ns.raw_dir, ns.staged_dir)
        for row in jobs.undecoded_air_members(spark, ns.raw_dir).toLocalIterator():
            print(f"not read (legacy format): {row.archive}: {row.member}", file=sys.stderr)
    elif ns.cmd == "normalise":
        jobs.normalise_staged(spark, ns.staged_dir, ns.normalised_dir)
    elif ns.cmd == "load":
        print(json.dumps(jobs.load_warehouse(spark, ns.normalised_dir, ns.warehouse_dir), default=str))
    elif ns.cmd == "verify":
        row = jobs.integrity_report(spark, ns.warehouse_dir).first().asDict()
        print(json.dumps(row, default=str))
        return 0 if row["integrity_ok"] else 1
    elif ns.cmd == "dq":
        for section, frame in jobs.quality_suite(spark, ns.warehouse_dir).items():
            print(f"== {section}")
            print("\t".join(frame.columns))
            for row in frame.toLocalIterator():  # every row, one partition at a time
                print("\t".join("" if v is None else str(v) for v in row))
    return 0


if __name__ == "__main__":
    sys.exit(main())
