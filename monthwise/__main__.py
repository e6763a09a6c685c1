"""Command line.

    python -m monthwise list
    python -m monthwise query NAME --sf-dir DIR --out PATH [--mode exact|corrected]
    python -m monthwise build --raw-root ROOT --as-of 2026-01-10T06:00:00 --spine-start 2020-01-01
                              [--clock SYSTEM.TABLE=TIMESTAMP ...] [--out ROOT]
                              [--target dev|prod] [--schema NAME] [--mode exact|corrected] [--no-gate]

``query`` runs one registered query over the test tables and writes it as
parquet; ``build`` runs the layered daily build over raw tables stored as
``{raw-root}/{system}/{table}`` (read with their contract schemas).  Use the
cluster's session settings; locally a session is started."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from monthwise.session import configure
    spark = SparkSession.builder.config("spark.ui.enabled", "false").getOrCreate()
    return configure(spark)


def _clock(text: str) -> tuple[tuple[str, str], dt.datetime]:
    name, _, at = text.partition("=")
    system, _, table = name.partition(".")
    return (system, table), dt.datetime.fromisoformat(at)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m monthwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", required=True)
    q.add_argument("--mode", default="exact", choices=["exact", "corrected"])
    b = sub.add_parser("build")
    b.add_argument("--raw-root", required=True)
    b.add_argument("--out")
    b.add_argument("--as-of", type=dt.datetime.fromisoformat, required=True)
    b.add_argument("--spine-start", type=dt.date.fromisoformat, required=True)
    b.add_argument("--clock", action="append", default=[], type=_clock, metavar="SYSTEM.TABLE=TIMESTAMP")
    b.add_argument("--mode", default="exact", choices=["exact", "corrected"])
    b.add_argument("--target", default="dev")
    b.add_argument("--schema", default="analytics")
    b.add_argument("--no-gate", action="store_true")
    args = ap.parse_args(argv)

    from monthwise import catalog
    from monthwise.fixture import FIXTURE
    from monthwise.params import Params

    if args.cmd == "list":
        for name in sorted(catalog.queries()):
            print(name)
        return 0
    spark = _session()
    if args.cmd == "query":
        qs = catalog.queries(FIXTURE.with_(mode=args.mode))
        qs[args.name](spark, args.sf_dir).write.mode("overwrite").parquet(args.out)
        return 0
    from monthwise.plans.build import build_all
    from monthwise.sources.registry import Sources
    p = Params(as_of=args.as_of, spine_start=args.spine_start, clocks=tuple(args.clock), mode=args.mode)
    out = build_all(spark, Sources.from_paths(spark, args.raw_root, params=p), p, args.out, args.target,
                    args.schema, run_gate=not args.no_gate)
    for r in out["dq_summary"].collect():           # one row per check
        print(f"{r['model']}.{r['column_name']} {r['test_name']}: {r['failures']} ({r['status']})")
    return 0


if __name__ == "__main__":
    sys.exit(main())
