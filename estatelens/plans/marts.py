"""End-to-end run: generate or read tables -> check and load -> build
the analytical marts (one Parquet dataset per job, for dashboards)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from estatelens.plans.registry import ANALYTICS
from estatelens.sources import catalog
from estatelens.sources.generator import generate


def build_marts(tables: Mapping[str, DataFrame], out_root: str, as_of=None,
                names: Iterable[str] | None = None) -> dict[str, str]:
    """Write each analytical job's full result to ``<out_root>/<name>``
    (overwrite: a mart is always rebuilt whole)."""
    paths = {}
    for name in names or ANALYTICS:
        path = f"{out_root.rstrip('/')}/{name}"
        ANALYTICS[name](tables, as_of).write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def run_end_to_end(spark: SparkSession, root: str, scale: float = 1.0, seed: int = 42,
                 as_of="2024-02-01") -> dict[str, object]:
    """Generate synthetic tables, load them with integrity checks under
    ``<root>/tables``, and build every mart under ``<root>/marts``."""
    tables_root = f"{root.rstrip('/')}/tables"
    rejected = catalog.load_tables(spark, generate(spark, scale, seed, as_of), tables_root)
    stored = catalog.read_tables(spark, tables_root)
    marts = build_marts(stored, f"{root.rstrip('/')}/marts", as_of)
    return {"rejected": rejected, "marts": marts}
