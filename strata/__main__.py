"""Command line: ``python -m strata <command> ...``.

  clean   --raw PATH --out PATH          raw CSV -> processed Parquet (L1)
  bridge  --tables DIR --out PATH        star-schema tables -> processed Parquet (L1)
  marts   --processed PATH [--extracts DIR]   marts, views, CSV extracts (L2)
  model   --processed PATH [--out DIR]   clustering, mortality model, risk classifier (L3)

On a cluster the session comes from spark-submit; locally a session is built.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from strata.session import local_session
    return local_session()


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="strata")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--raw", required=True)
    c.add_argument("--out", required=True)
    b = sub.add_parser("bridge")
    b.add_argument("--tables", required=True)
    b.add_argument("--out", required=True)
    m = sub.add_parser("marts")
    m.add_argument("--processed", required=True)
    m.add_argument("--extracts")
    t = sub.add_parser("model")
    t.add_argument("--processed", required=True)
    t.add_argument("--out")
    args = p.parse_args(argv)
    spark = _session()

    if args.cmd in ("clean", "bridge"):
        from strata.operators.clean import CleanReport
        from strata.plans.cleaning import run_pipeline
        if args.cmd == "clean":
            from strata.sources.raw_csv import load_raw
            raw = load_raw(spark, args.raw)
        else:
            from strata.sources.bridge import obs_raw
            raw = obs_raw(spark, args.tables)
        report = CleanReport()
        out = run_pipeline(spark, raw, args.out, report=report)
        print(json.dumps({"rows_in": report.rows_in, "dropped_missing_value": report.dropped_missing_value,
                          "dropped_missing_location": report.dropped_missing_location,
                          "rows_out": report.rows_out, "columns": len(out.columns)}))
        for r in out.groupBy("risk_level").count().orderBy("risk_level").collect():
            print(r["risk_level"], r["count"])
    elif args.cmd == "marts":
        from strata.plans.marts import run
        res = run(spark, args.processed, args.extracts)
        for name, df in res["questions"].items():
            print(f"== {name}")
            df.show(20, truncate=False)
    else:
        from strata.plans.modeling import run
        from strata.sources.parquet import load_processed
        res = run(spark, load_processed(spark, args.processed), args.out)
        res["summary"].show(truncate=False)


if __name__ == "__main__":
    main()
