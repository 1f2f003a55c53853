"""Read the brokerage tables from (and append them to) an existing
relational database over JDBC.

Reads are split into ``num_partitions`` parallel range scans on the primary
key: the key bounds come from one pushed-down ``min/max`` query, and Spark
issues one ``WHERE pk >= a AND pk < b`` query per partition, so no single
task pulls a whole table.  Results are conformed to the declared schema.

Not exercised against a live database in this repository (no database
server is started here); the option building is unit-tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estatelens.schemas import TABLES, conform


def bounds_query(table: str) -> str:
    pk = TABLES[table].primary_key
    return f"(SELECT MIN({pk}) AS lo, MAX({pk}) AS hi FROM {table}) AS b"


def partitioned_read_options(table: str, lo: int, hi: int, num_partitions: int) -> dict[str, str]:
    """Options for a primary-key range-partitioned JDBC read."""
    return {
        "dbtable": table,
        "partitionColumn": TABLES[table].primary_key,
        "lowerBound": str(lo),
        "upperBound": str(hi + 1),
        "numPartitions": str(max(1, num_partitions)),
        "fetchsize": "10000",
    }


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
                    num_partitions: int = 64) -> DataFrame:
    """One brokerage table from the database, in parallel key ranges."""
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    b = reader.option("dbtable", bounds_query(table)).load().first()
    if b is None or b["lo"] is None:  # empty table
        return conform(reader.option("dbtable", table).load(), table)
    opts = partitioned_read_options(table, int(b["lo"]), int(b["hi"]), num_partitions)
    return conform(reader.options(**opts).load(), table)


def append_jdbc_table(df: DataFrame, url: str, table: str, properties: dict[str, str],
                      batch_size: int = 10_000) -> None:
    """Append rows (the database assigns nothing: keys are already set)."""
    (conform(df, table).write.format("jdbc").option("url", url).options(**properties)
        .option("dbtable", table).option("batchsize", str(batch_size)).mode("append").save())
