"""Command line: run jobs over a table root written by the catalog.

    python -m estatelens load  --tables ROOT [--scale 1.0] [--seed 42]
    python -m estatelens query NAME --tables ROOT [--as-of 2024-02-01] [--out PATH] [--show 20]
    python -m estatelens marts --tables ROOT --out ROOT [--as-of DATE]
    python -m estatelens check --tables ROOT [--out PATH]
    python -m estatelens list

``query`` prints the first rows (or writes the whole result as Parquet with
``--out``); ``check`` runs the three data-quality reports; ``marts`` writes
every analytical result.  The session comes from ``spark-submit`` settings
when run on a cluster.
"""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame


def _jobs():
    from estatelens.plans.registry import ANALYTICS, BUILDING_BLOCKS, QUALITY, REFERENTIAL

    return {**ANALYTICS, **QUALITY, **REFERENTIAL, **BUILDING_BLOCKS}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="estatelens")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("name")
    for sp in (q, sub.add_parser("load"), sub.add_parser("marts"), sub.add_parser("check")):
        sp.add_argument("--tables", required=True)
        sp.add_argument("--as-of", default=None)
        sp.add_argument("--out", default=None)
        sp.add_argument("--largest-shuffle-gb", type=float, default=None,
                        help="size of the largest shuffle expected; sets the number of shuffle partitions")
    q.add_argument("--show", type=int, default=20)
    load = sub.choices["load"]
    load.add_argument("--scale", type=float, default=1.0)
    load.add_argument("--seed", type=int, default=42)
    args = p.parse_args(argv)

    if args.cmd == "list":
        print("\n".join(_jobs()))
        return 0

    from estatelens.session import get_spark
    from estatelens.sources import catalog

    gb = args.largest_shuffle_gb
    spark = get_spark(largest_shuffle_bytes=None if gb is None else gb * 1e9)
    if args.cmd == "load":
        from estatelens.sources.generator import generate

        as_of = args.as_of or "2024-02-01"
        rejected = catalog.load_tables(spark, generate(spark, args.scale, args.seed, as_of), args.tables)
        print({k: v for k, v in rejected.items() if v})
        return 0
    tables = catalog.read_tables(spark, args.tables)
    if args.cmd == "query":
        df = _jobs()[args.name](tables, args.as_of)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(args.show, truncate=False)
        return 0
    if args.cmd == "marts":
        from estatelens.plans.marts import build_marts

        if not args.out:
            p.error("marts needs --out")
        for name, path in build_marts(tables, args.out, args.as_of).items():
            print(name, path)
        return 0
    if args.cmd == "check":
        from estatelens.operators import quality

        report = reduce(DataFrame.unionByName, [
            quality.row_rule_report(tables), quality.key_rule_report(tables),
            quality.foreign_key_report(tables),
        ])
        if args.out:
            report.write.mode("overwrite").parquet(args.out)
        else:
            found = report.where("violations > 0")
            found.show(found.count(), truncate=False)
        return 0
    return 1


if __name__ == "__main__":
    sys.exit(main())
