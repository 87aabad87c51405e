"""Command line: the end-to-end layer job over folders of raw files.

    python -m medallion run --institutions DIR --profiles DIR [DIR ...] --claims DIR --root OUT

Each source folder is read by its contract (header groups, encodings, unnamed
tail columns); raw, trusted and delivery layers are written below ``--root``
(any Hadoop URI) and the per-table row counts are printed as JSON.
"""

from __future__ import annotations

import argparse
import json
import sys

from medallion.contracts import CLAIMS, INSTITUTIONS, PROFILES
from medallion.plans.layers import RawInputs, run_pipeline
from medallion.session import get_spark
from medallion.sources.delimited import read_contract


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="medallion")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="raw -> trusted -> delivery over folders of delimited files")
    run.add_argument("--institutions", required=True, nargs="+", help="tab-separated registry folder(s)")
    run.add_argument("--profiles", required=True, nargs="+", help="pipe-separated profile folder(s)")
    run.add_argument("--claims", required=True, nargs="+", help="semicolon-separated claim folder(s)")
    run.add_argument("--claims-encoding", default=CLAIMS.encoding)
    run.add_argument("--root", required=True, help="output root for the layers")
    run.add_argument("--master", default=None, help="Spark master (default: the launcher's)")
    run.add_argument("--shuffle-partitions", type=int, default=None)
    return p


def run_from_folders(spark, institutions, profiles, claims, root, claims_encoding=None) -> dict[str, int]:
    raw = RawInputs(
        institutions=read_contract(spark, institutions, INSTITUTIONS),
        profiles=read_contract(spark, profiles, PROFILES),
        claims=read_contract(spark, claims, CLAIMS, encoding=claims_encoding),
    )
    audit: dict[str, int] = {}
    run_pipeline(spark, raw, root, audit=audit)
    return audit


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = get_spark(args.master, app_name="medallion-run", shuffle_partitions=args.shuffle_partitions)
    audit = run_from_folders(spark, args.institutions, args.profiles, args.claims, args.root,
                             args.claims_encoding)
    print(json.dumps(audit, sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main())
