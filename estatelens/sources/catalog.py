"""The brokerage tables as Parquet datasets under one root folder.

Layout: ``<root>/<table>/load_batch=<n>/part-*.parquet``.  Every load (the
initial bulk load is batch 0, each later append or streaming micro-batch
gets its own number) writes one partition with dynamic partition overwrite,
so re-running a failed load replaces its own output instead of duplicating
rows.  Rows that break a declared rule go to ``<root>/_rejected/<table>``
with the list of failed rules.

Tables are loaded parents first.  A child's foreign keys are checked against
the parent rows already *written* (read back from storage), which is both
the database's insert-time check and a lineage cut: the child's plan starts
at the parent's files, not at the parent's whole computation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark import StorageLevel

from estatelens.operators.lineage import cut, small_or_shuffled
from estatelens.operators.lookup import flag_members
from estatelens.operators.quality import apply_defaults, key_rules, split
from estatelens.schemas import LOAD_ORDER, TABLES, Table

BATCH_COL = "load_batch"

# Physical layout.  Tables the jobs filter by a date window (listings by
# listing_date, commissions by paid_date) are range-partitioned on that date
# when written, so each file covers a disjoint date range: for a date window
# the Parquet reader reads only the footers of files outside it and skips
# all their row groups.  Every listed table is also sorted inside its files,
# so row groups are skipped and keys compress well.
RANGE_KEYS = {
    # the primary key breaks ties, so a date holding a third of the rows is
    # still spread over many files (each still covering a contiguous range)
    "listings": ("listing_date", "listing_id"),
    "commissions": ("paid_date", "commission_id"),
}
SORT_KEYS = {
    **RANGE_KEYS,
    "property_price_history": ("listing_id",),
    "customer_interactions": ("listing_id",),
    "offers": ("listing_id",),
}


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def rejected_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/_rejected/{table}"


def read_table(spark: SparkSession, root: str, table: str,
               exclude_batch: int | None = None) -> DataFrame:
    """Read one table with its declared schema (never inferred).

    ``exclude_batch`` leaves out one load batch (partition pruned), so a
    replayed batch is checked against the rows stored before it."""
    t = TABLES[table]
    schema = T.StructType(t.schema.fields + [T.StructField(BATCH_COL, T.LongType())])
    df = spark.read.schema(schema).parquet(table_path(root, table))
    if exclude_batch is not None:
        df = df.where(F.col(BATCH_COL) != exclude_batch)
    return df.select(*t.column_names)


EMPTY_BATCH = -1


def table_exists(spark: SparkSession, root: str, table: str) -> bool:
    try:
        spark.read.schema(TABLES[table].schema).parquet(table_path(root, table))
        return True
    except AnalysisException:
        return False


def create_table(spark: SparkSession, root: str, table: str) -> None:
    """Create ``table`` empty unless it exists: one empty ``load_batch=-1``
    partition holding only the schema, so every reader - including plans
    cached before the first real batch lands - sees the same partition
    column."""
    if table_exists(spark, root, table):
        return
    empty = spark.createDataFrame([], TABLES[table].schema).coalesce(1)
    empty.write.mode("ignore").parquet(f"{table_path(root, table)}/{BATCH_COL}={EMPTY_BATCH}")


def read_rejected(spark: SparkSession, root: str, table: str) -> DataFrame:
    t = TABLES[table]
    schema = T.StructType(t.schema.fields + [
        T.StructField("failed_rules", T.ArrayType(T.StringType())),
        T.StructField(BATCH_COL, T.LongType()),
    ])
    return spark.read.schema(schema).parquet(rejected_path(root, table))


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name) for name in TABLES}


def check_rows(df: DataFrame, table: Table, parents: Mapping[str, DataFrame]) -> DataFrame:
    """``df`` plus a ``failed_rules`` array (empty = the row may be stored).

    Row rules first (defaults applied), then foreign keys against the stored
    parents, then PRIMARY KEY / UNIQUE duplicates among the rows that pass
    both (and, for appends, against ``parents[table]`` - the rows already
    stored), so an orphan rejects no other row.  Each key rule is judged on
    its key columns of those rows, whatever the other key rules say, so the
    joins grow with the number of rules.  No join can multiply rows.

    An append costs its batch, not the stored tables: the batch's distinct
    values are cut and, if they are small enough, broadcast to the scans of
    the parents and of the stored keys, so only keys of the batch go on."""
    tagged, _ = split(apply_defaults(df, table), table, keep_tagged=True)
    rules = F.col("failed_rules")
    existing = parents.get(table.name)

    def of_batch(stored: DataFrame, batch: DataFrame, columns: list[str]) -> DataFrame:
        """The rows of ``stored`` that are among the batch's distinct ones."""
        if existing is not None:
            batch = small_or_shuffled(cut(batch), 64 * len(columns))
        return stored.join(batch, columns, "left_semi")

    def flag(rows: DataFrame, cond, rule_id: str) -> DataFrame:
        return rows.withColumn("failed_rules", F.when(cond, F.array_append(rules, F.lit(rule_id))).otherwise(rules))

    for fk in table.foreign_keys:
        parent = parents.get(fk.parent)
        if parent is None:
            continue
        # stored parents passed their key check: unique keys, no fan-out
        wanted = tagged.select(F.col(fk.column).alias(fk.parent_column)).dropna().distinct()
        known = of_batch(parent.select(fk.parent_column), wanted, [fk.parent_column]) if existing is not None else parent.select(fk.parent_column)
        looked = flag_members(tagged, [fk.column], known, "__hit", table.primary_key)
        tagged = flag(looked, F.col(fk.column).isNotNull() & F.col("__hit").isNull(),
                      f"foreign_key:{fk.column}->{fk.parent}").drop("__hit")
    clean = tagged.where(F.size(rules) == 0)
    tagged = tagged.withColumn("__clean", F.size(rules) == 0)
    for rule_id, cols in key_rules(table):
        keys = clean.select(*cols).dropna().groupBy(*cols).count()
        taken = keys.where(F.col("count") > 1).select(*cols)
        if existing is not None:
            stored = of_batch(existing.select(*cols), keys.select(*cols), list(cols))
            taken = taken.unionByName(stored).distinct()
        looked = flag_members(tagged, cols, taken, "__dup", table.primary_key)
        tagged = flag(looked, F.col("__dup") & F.col("__clean"), rule_id).drop("__dup")
    return tagged.select(*table.column_names, "failed_rules")


def write_batch(good: DataFrame, bad: DataFrame, root: str, table: str, batch: int,
                replace_table: bool = False) -> None:
    """Write one load batch of ``table``.

    Normally only the batch's own partition is replaced (idempotent per
    batch number); ``replace_table`` drops every earlier batch first - the
    full rebuild of a DROP TABLE + CREATE + INSERT."""
    mode = "static" if replace_table else "dynamic"
    # Rejected rows first: writing the table path makes Spark re-cache any
    # plan that reads it (appends read the stored rows for key checks), so
    # the table is written last.
    (bad.withColumn(BATCH_COL, F.lit(batch).cast("long"))
        .write.mode("overwrite").option("partitionOverwriteMode", mode)
        .partitionBy(BATCH_COL).parquet(rejected_path(root, table)))
    out = good.withColumn(BATCH_COL, F.lit(batch).cast("long"))
    if table in RANGE_KEYS:
        out = out.repartitionByRange(*RANGE_KEYS[table])
    if table in SORT_KEYS:
        out = out.sortWithinPartitions(*SORT_KEYS[table])
    (out.write.mode("overwrite").option("partitionOverwriteMode", mode)
        .partitionBy(BATCH_COL).parquet(table_path(root, table)))


def stored_or_empty(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of ``table`` under ``root``; none if it was never loaded, so
    that every reference to it is an orphan."""
    try:
        return read_table(spark, root, table)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], TABLES[table].schema)


def _stored_descendants(spark: SparkSession, root: str, given: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Copies of the stored tables that refer to a table of ``given``,
    directly or through another of them, and are not given themselves."""
    out: dict[str, DataFrame] = {}
    reached = set(given)
    for t in LOAD_ORDER:
        if t.name in reached or not any(fk.parent in reached for fk in t.foreign_keys):
            continue
        stored = stored_or_empty(spark, root, t.name)
        if not stored.isEmpty():
            reached.add(t.name)
            out[t.name] = cut(stored)  # its own files are about to be replaced
    return out


def load_tables(spark: SparkSession, tables: Mapping[str, DataFrame], root: str,
                batch: int = 0, append: bool = False) -> dict[str, int]:
    """Check and write ``tables`` parents first; returns rejected-row counts.

    ``append=False`` is the full rebuild (the first batch of a fresh root);
    ``append=True`` adds a new batch and checks keys against stored rows.

    A rebuilt parent may lack keys that stored tables refer to.  Stored
    children of the rebuilt tables, and theirs, that are not given are
    therefore loaded again from storage, as this batch: their orphans go to
    the rejected rows, and the result counts them.
    """
    if not append:
        tables = {**_stored_descendants(spark, root, tables), **tables}
    rejected: dict[str, int] = {}
    stored: dict[str, DataFrame] = {}
    for t in LOAD_ORDER:
        if t.name not in tables:
            continue
        parents = {}
        for fk in t.foreign_keys:
            if fk.parent in stored:
                parents[fk.parent] = stored[fk.parent]
            else:
                parents[fk.parent] = stored_or_empty(spark, root, fk.parent)
        if append:
            parents[t.name] = read_table(spark, root, t.name, exclude_batch=batch)
        tagged = check_rows(tables[t.name], t, parents).persist(StorageLevel.MEMORY_AND_DISK)
        good = tagged.where(F.size("failed_rules") == 0).drop("failed_rules")
        bad = tagged.where(F.size("failed_rules") > 0)
        write_batch(good, bad, root, t.name, batch, replace_table=not append)
        tagged.unpersist()
        stored[t.name] = read_table(spark, root, t.name)
        rejected[t.name] = read_rejected(spark, root, t.name).where(F.col(BATCH_COL) == batch).count()
    return rejected
