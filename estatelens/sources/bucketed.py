"""Tables stored co-partitioned by listing, so that they join on it without
moving.

The listings, the three tables that refer to one, and the offers' outcomes
(which a contract tells) are written as Spark bucketed tables: rows are dealt by a hash of ``listing_id`` to the same number of buckets,
sorted inside.  A join or an aggregate on ``listing_id`` then reads bucket by
bucket, and the shuffle is paid once, when the table is written.

A task reads a whole bucket, so a bucket must fit one: choose ``buckets`` by
the largest table's size.  Rows without a listing are all in one bucket, and
a listing that holds much of a table is too; tables with such keys
(:func:`crowded`) are better left unbucketed, where joins split them.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.operators.lineage import scratch
from estatelens.operators.market import offer_outcomes
from estatelens.schemas import TABLES

KEY = "listing_id"
BUCKETED = ("listings", "property_price_history", "customer_interactions", "offers", "offer_outcomes")
BUCKETS = 64


def crowded(table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(listing_id, rows): keys, NULL included, with more rows than two
    buckets have on average; at most ``buckets / 2`` of them."""
    sizes = table.groupBy(KEY).agg(F.count(F.lit(1)).alias("rows"))
    total = F.coalesce(table.select(F.count(F.lit(1))).scalar(), F.lit(0))
    return sizes.where(F.col("rows") * buckets > total * 2)


def store(tables: Mapping[str, DataFrame], root: str, prefix: str, buckets: int = BUCKETS,
          names: Sequence[str] = BUCKETED) -> None:
    """Write ``names`` under ``root`` as the catalog's ``<prefix>_<table>``,
    bucketed and sorted by ``listing_id``; existing ones are replaced."""
    for name in names:
        df = offer_outcomes(tables) if name == "offer_outcomes" else tables[name].select(*TABLES[name].column_names)
        (df.repartition(buckets, KEY).write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY)
         .option("path", f"{root.rstrip('/')}/{name}").saveAsTable(f"{prefix}_{name}"))


def read(spark: SparkSession, prefix: str, others: Mapping[str, DataFrame], names: Sequence[str] = BUCKETED) -> dict[str, DataFrame]:
    """All tables: the stored ``names`` and, for the rest, ``others``."""
    return {**others, **{n: spark.table(f"{prefix}_{n}") for n in names}}


def stored(tables: Mapping[str, DataFrame], buckets: int | None = None) -> dict[str, DataFrame]:
    """``tables`` with those of ``BUCKETED`` written once to the shared
    folder and read back; by default as many buckets as shuffle partitions."""
    spark = tables["listings"].sparkSession
    prefix = f"estatelens_{uuid.uuid4().hex}"
    store(tables, scratch(spark), prefix, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    return read(spark, prefix, tables)
