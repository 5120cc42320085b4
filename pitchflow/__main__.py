"""Command line: ``python -m pitchflow <command>``.

* ``refresh``: ingest new landing files and bring Silver and Gold up to date, also after
  a refresh that failed; prints the rule report. Paths come from the arguments or from the session
  settings ``spark.pitchflow.landing`` and ``spark.pitchflow.root``.
* ``query NAME``: run one registered query on a data folder and show it.
* ``list``: the registered query names.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from pitchflow.plans import catalog, layers


def _session(local: bool) -> SparkSession:
    if local:
        from pitchflow.session import local_session

        return local_session()
    return SparkSession.builder.appName("pitchflow").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pitchflow")
    parser.add_argument("--local", action="store_true", help="start a local[*] session")
    sub = parser.add_subparsers(dest="command", required=True)

    refresh = sub.add_parser("refresh", help="landing -> Bronze -> Silver -> Gold")
    refresh.add_argument("--landing", help="landing files (folder or glob)")
    refresh.add_argument("--root", help="folder holding the layer tables")
    refresh.add_argument("--multi-line", action="store_true", help="one document per file")
    refresh.add_argument("--infer-types", action="store_true", help="read Bronze with the types its documents had")
    refresh.add_argument("--full-silver", action="store_true", help="rebuild Silver from all of Bronze")
    refresh.add_argument("--register", action="store_true", help="name the tables in the catalog")

    query = sub.add_parser("query", help="run one registered query")
    query.add_argument("name", choices=sorted(catalog.QUERIES))
    query.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    query.add_argument("--rows", type=int, default=20)

    sub.add_parser("list", help="registered query names")
    args = parser.parse_args(argv)

    if args.command == "list":
        print("\n".join(catalog.QUERIES))
        return 0

    spark = _session(args.local)
    if args.command == "query":
        catalog.queries()[args.name](spark, args.sf_dir).show(args.rows, truncate=False)
        return 0

    landing = args.landing or spark.conf.get("spark.pitchflow.landing", None)
    root = args.root or spark.conf.get("spark.pitchflow.root", None)
    if not landing or not root:
        parser.error("give --landing and --root, or set spark.pitchflow.landing / spark.pitchflow.root")
    run = layers.refresh_layers(
        spark, landing, root,
        multi_line=args.multi_line, infer_types=args.infer_types,
        register=args.register, full_silver=args.full_silver,
    )
    print(json.dumps({"documents": run.bronze.documents, "malformed": run.bronze.malformed, "rules": run.rules}, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
