"""Command line: ``python -m citymarts refresh --raw DIR --out DIR [--as-of TS] [--incremental]``
and ``python -m citymarts compact --out DIR``.

Exit code 0 = all stages and gates passed, 1 = a stage failed, 2 = a
quality gate failed (the scheduler's retry/alert contract).
"""

from __future__ import annotations

import argparse
import sys

from citymarts.session import apply_scale_conf, build_session, input_size


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="citymarts")
    sub = parser.add_subparsers(dest="command", required=True)
    r = sub.add_parser("refresh", help="raw sync -> facts -> marts -> gates")
    r.add_argument("--raw", required=True, help="evidence root (one folder per source)")
    r.add_argument("--out", required=True, help="warehouse root")
    r.add_argument("--as-of", default=None, help="run clock, 'YYYY-MM-DD HH:MM:SS' (default: now, UTC)")
    r.add_argument("--run-id", default=None)
    r.add_argument("--incremental", action="store_true", help="merge new deliveries, rebuild affected months only")
    r.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    r.add_argument(
        "--input-bytes", type=int, default=None, help="input volume for partition sizing (default: size of --raw)"
    )
    c = sub.add_parser("compact", help="pack the small files of many loads")
    c.add_argument("--out", required=True, help="warehouse root")
    c.add_argument("--master", default=None)
    args = parser.parse_args(argv)

    spark = build_session(master=args.master)
    try:
        if args.command == "compact":
            from citymarts.plans.refresh import compact_warehouse

            print(compact_warehouse(spark, args.out))
            return 0
        apply_scale_conf(spark, args.input_bytes if args.input_bytes is not None else input_size(spark, args.raw))
        from citymarts.plans.refresh import refresh

        return refresh(spark, args.raw, args.out, args.as_of, args.run_id, incremental=args.incremental)
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
