"""Summarise every job's physical plan as it would run at scale.

The jobs are planned over tables stored by the catalog (generated data,
loaded into a scratch folder) with size-based broadcasting disabled and AQE
off, so the printed shape is the static plan for inputs too large to
broadcast.  Writes a Markdown table to stdout:

    python tools/plan_report.py [scratch_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(plan: str) -> dict:
    tree = plan.split("\n\n")[0]
    details = plan[len(tree):]
    scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(.*?)(?=\n\(\d+\)|\Z)", details, re.S)
    read_cols = [len(re.findall(r":", m.group(1))) for s in scans
                 for m in [re.search(r"ReadSchema: struct<(.*)>", s)] if m]
    pushed = sum(1 for s in scans if re.search(r"PushedFilters: \[[^\]]", s))
    return {
        "exchanges": len(re.findall(r"\bExchange \(", tree)),
        "reused": len(re.findall(r"ReusedExchange", tree)),
        "smj": tree.count("SortMergeJoin"),
        "bhj": tree.count("BroadcastHashJoin"),
        "hash_agg": tree.count("HashAggregate"),
        "sort_agg": tree.count("SortAggregate"),
        "window": tree.count("Window ("),
        "nested_loop": tree.count("BroadcastNestedLoopJoin") + tree.count("CartesianProduct"),
        "scans": len(scans),
        "max_cols_read": max(read_cols) if read_cols else 0,
        "scans_with_pushed_filters": pushed,
        "codegen_stages": len(set(re.findall(r"\* \w+ \((\d+)\)", tree))),
    }


def main() -> None:
    from estatelens.plans.registry import ANALYTICS, BUILDING_BLOCKS, INCREMENTAL, QUALITY, REFERENTIAL, ROW_ORDER, STORED
    from estatelens.session import get_spark
    from estatelens.sources import catalog
    from estatelens.sources.generator import generate

    scratch = sys.argv[1] if len(sys.argv) > 1 else tempfile.mkdtemp(prefix="plans-")
    spark = get_spark(shuffle_partitions=8)
    root = os.path.join(scratch, "tables")
    catalog.load_tables(spark, generate(spark, scale=2.0, seed=1), root)
    tables = catalog.read_tables(spark, root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")

    jobs = {**ANALYTICS, **QUALITY, **REFERENTIAL, **BUILDING_BLOCKS, **ROW_ORDER, **INCREMENTAL, **STORED}
    print("| job | exchanges (reused) | sort-merge joins | hash aggs | sort aggs | windows | nested-loop/cartesian | scans (with pushed filters) | widest scan (cols) |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, job in jobs.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            job(tables, "2024-02-01").explain("formatted")
        s = summarize(buf.getvalue())
        print(f"| {name} | {s['exchanges']} ({s['reused']}) | {s['smj']} | {s['hash_agg']} | "
              f"{s['sort_agg']} | {s['window']} | {s['nested_loop']} | "
              f"{s['scans']} ({s['scans_with_pushed_filters']}) | {s['max_cols_read']} |")
    spark.stop()


if __name__ == "__main__":
    main()
