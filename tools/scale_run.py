"""Scale-up run: generate -> checked load -> time every analytical job.

    python tools/scale_run.py SCRATCH_DIR SCALE [CPUS] [--reuse]

Generates the 14 tables at ``SCALE`` times the reference row counts with
the distributed generator, loads them through the checked catalog (rule
checks, key checks, foreign keys against stored parents), then times each
analytical job over the stored Parquet tables (best of 2 runs, ``noop``
sink).  Prints one JSON line with row counts, load time and query times.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    scratch, scale = sys.argv[1], float(sys.argv[2])
    args = [a for a in sys.argv[3:] if not a.startswith("--")]
    cpus = int(args[0]) if args else 8
    reuse = "--reuse" in sys.argv  # time the jobs over tables loaded by an earlier run

    from estatelens.plans.registry import ANALYTICS
    from estatelens.session import get_spark
    from estatelens.sources import catalog
    from estatelens.sources.generator import generate

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=4 * cpus,
                      extra={"spark.driver.memory": "20g"},
                      checkpoint_dir=os.path.join(scratch, "checkpoints"))
    root = os.path.join(scratch, "tables")
    t0 = time.perf_counter()
    rejected = {} if reuse else catalog.load_tables(spark, generate(spark, scale=scale, seed=42), root)
    load_s = time.perf_counter() - t0
    tables = catalog.read_tables(spark, root)
    rows = {name: df.count() for name, df in tables.items()}

    times = {}
    for name, job in ANALYTICS.items():
        best = None
        for _ in range(2):
            t1 = time.perf_counter()
            job(tables, "2024-02-01").write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t1
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    print(json.dumps({"scale": scale, "rows": rows, "rejected": sum(rejected.values()),
                      "load_sec": round(load_s, 1), "queries": times,
                      "analytics_sec": round(sum(times.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
