"""Referential actions as set-based jobs: ON DELETE CASCADE, ON DELETE SET
NULL and ON UPDATE CASCADE over the declared foreign keys.

A delete is a DataFrame of doomed parent keys.  Tables are visited parents
first (the load order), so a deletion reaches grandchildren (property ->
listings -> price history, offers -> contracts) before SET NULL is applied
to the surviving rows of later tables.  Each level is an anti join (delete)
or a left join against a de-duplicated key set (SET NULL) - never a join
that can multiply rows.

The doomed key set of every level that another one reads is written to the
shared folder and read back: later levels reuse it without recomputing the
chain above, and a lost executor only recomputes from the last one.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.operators.lineage import cut
from estatelens.operators.lookup import flag_members
from estatelens.schemas import LOAD_ORDER, TABLES, children_of

Tables = Mapping[str, DataFrame]


@dataclass
class DeleteResult:
    tables: dict[str, DataFrame]
    deleted: dict[str, DataFrame] = field(default_factory=dict)  # table -> doomed PKs
    nulled: dict[str, list[tuple[str, DataFrame]]] = field(default_factory=dict)


def delete_cascade(t: Tables, table: str, keys: DataFrame, materialize: bool = True) -> DeleteResult:
    """Delete the rows of ``table`` whose primary key is in ``keys`` (a
    one-column DataFrame) and apply every declared ON DELETE action.  With
    ``materialize`` false the key sets keep their lineage (small tables)."""
    kept = cut if materialize else (lambda df: df)
    pk = TABLES[table].primary_key
    out = dict(t)
    res = DeleteResult(out)
    wanted = keys.select(F.col(keys.columns[0]).alias(pk))
    present = t[table].select(pk).join(wanted, pk, "left_semi").distinct()
    res.deleted[table] = kept(present)
    for tb in LOAD_ORDER:
        df = t[tb.name]
        sources = []
        for fk in tb.foreign_keys:
            if fk.on_delete == "cascade" and fk.parent in res.deleted:
                parent_keys = res.deleted[fk.parent].select(F.col(fk.parent_column).alias(fk.column))
                sources.append(df.join(parent_keys, fk.column, "left_semi").select(tb.primary_key))
        if sources and tb.name != table:
            doomed = reduce(DataFrame.union, sources).distinct()
            # only a key set that later levels read is worth a lineage cut
            res.deleted[tb.name] = kept(doomed) if children_of(tb.name) else doomed
        if tb.name in res.deleted:
            df = df.join(res.deleted[tb.name], tb.primary_key, "left_anti")
        for fk in tb.foreign_keys:
            if fk.on_delete == "set_null" and fk.parent in res.deleted:
                gone = res.deleted[fk.parent].select(fk.parent_column)
                df = flag_members(df, [fk.column], gone, "__hit", tb.primary_key)
                res.nulled.setdefault(tb.name, []).append(
                    (fk.column, df.where(F.col("__hit")).select(tb.primary_key))
                )
                df = df.withColumn(
                    fk.column, F.when(F.col("__hit"), F.lit(None)).otherwise(F.col(fk.column))
                ).drop("__hit")
        out[tb.name] = df.select(*tb.column_names)
    return res


def delete_report(res: DeleteResult) -> DataFrame:
    """(table_name, deleted_rows, nulled_references) for all 14 tables."""
    spark = next(iter(res.tables.values())).sparkSession
    zero = spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
    parts = []
    for tb in LOAD_ORDER:
        deleted = (
            res.deleted[tb.name].agg(F.count(F.lit(1)).alias("n"))
            if tb.name in res.deleted
            else zero
        )
        nulled_parts = [d.agg(F.count(F.lit(1)).alias("n")) for _, d in res.nulled.get(tb.name, [])]
        nulled = reduce(DataFrame.union, nulled_parts) if nulled_parts else zero
        parts.append(_one_row(tb.name, deleted, nulled))
    return reduce(DataFrame.unionByName, parts)


def survivor_report(res: DeleteResult) -> DataFrame:
    """What a delete leaves, for the key and every foreign key column of
    the 14 tables: (table_name, column_name, row_count, filled, key_sum).
    One pass over each table that is left."""
    parts = []
    for tb in LOAD_ORDER:
        names = [tb.primary_key] + [fk.column for fk in tb.foreign_keys]
        sums = res.tables[tb.name].agg(F.count(F.lit(1)).alias("row_count"), *[
            x for i, c in enumerate(names) for x in (F.count(c).alias(f"n{i}"), F.sum(c).cast("bigint").alias(f"s{i}"))])
        columns = ", ".join(f"'{c}', n{i}, s{i}" for i, c in enumerate(names))
        parts.append(sums.select(F.lit(tb.name).alias("table_name"), "row_count",
                                 F.expr(f"stack({len(names)}, {columns}) AS (column_name, filled, key_sum)")))
    return reduce(DataFrame.unionByName, parts)


def _one_row(name: str, deleted: DataFrame, nulled: DataFrame) -> DataFrame:
    # Two one-row aggregates side by side without a join: tag and pivot.
    both = deleted.select(F.lit("d").alias("k"), F.col("n").cast("bigint").alias("v")).unionByName(
        nulled.select(F.lit("m").alias("k"), F.col("n").cast("bigint").alias("v"))
    )
    return both.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum(F.when(F.col("k") == "d", F.col("v"))), F.lit(0)).alias("deleted_rows"),
        F.coalesce(F.sum(F.when(F.col("k") == "m", F.col("v"))), F.lit(0)).alias("nulled_references"),
    )


def rekey(t: Tables, table: str, mapping: DataFrame) -> dict[str, DataFrame]:
    """ON UPDATE CASCADE: renumber ``table``'s primary key with ``mapping``
    (columns ``old_key``, ``new_key``; injective) and carry the new values
    into every referencing column.  Unmapped keys stay as they are.

    A mapping that gives an old key two new ones, or a new key that another
    row of the table has or gets, is refused with ValueError."""
    pk = TABLES[table].primary_key
    m = cut(mapping.select(F.col("old_key").alias("__old"), F.col("new_key").alias("__new")).distinct())

    def remap(df: DataFrame, col: str, cols: list[str]) -> DataFrame:
        j = df.join(m, F.col(col) == F.col("__old"), "left")
        return j.withColumn(col, F.coalesce(F.col("__new"), F.col(col))).select(*cols)

    out = dict(t)
    out[table] = remap(t[table], pk, TABLES[table].column_names)
    twice = F.when(F.count(F.lit(1)) > 1, 1).alias("twice")
    olds, news = m.groupBy("__old").agg(twice), out[table].groupBy(pk).agg(twice)
    bad = olds.select(F.col("twice").alias("old"), F.lit(None).cast("int").alias("new")).unionAll(
        news.select(F.lit(None).cast("int"), "twice")).agg(F.max("old").alias("old"), F.max("new").alias("new")).first()
    if bad["old"]:
        raise ValueError("mapping gives an old key more than one new key")
    if bad["new"]:
        raise ValueError(f"mapping makes {pk} ambiguous")
    for child, fk in children_of(table):
        out[child.name] = remap(out[child.name], fk.column, child.column_names)
    return out


# --- jobs registered as queries --------------------------------------------
def _purge_withdrawn(t: Tables) -> DeleteResult:
    return delete_cascade(t, "listings", t["listings"].where(F.col("listing_status") == "Withdrawn").select("listing_id"))


def _purge_renters(t: Tables) -> DeleteResult:
    return delete_cascade(t, "customers", t["customers"].where(F.col("customer_type") == "renter").select("customer_id"))


def withdrawn_listing_purge(t: Tables, as_of=None) -> DataFrame:
    """Delete every Withdrawn listing: its price history, offers and their
    contracts go with it, interactions keep their rows with listing_id NULL."""
    return delete_report(_purge_withdrawn(t))


def withdrawn_listing_purge_survivors(t: Tables, as_of=None) -> DataFrame:
    """Rows, keys and references that are left after that purge."""
    return survivor_report(_purge_withdrawn(t))


def renter_customer_purge(t: Tables, as_of=None) -> DataFrame:
    """Delete every renter customer: leads, interactions, offers and the
    offers' contracts follow; other customers' interactions on the deleted
    leads keep their rows with lead_id NULL."""
    return delete_report(_purge_renters(t))


def renter_customer_purge_survivors(t: Tables, as_of=None) -> DataFrame:
    """Rows, keys and references that are left after that purge."""
    return survivor_report(_purge_renters(t))


def agent_renumbering(t: Tables, as_of=None) -> DataFrame:
    """Mirror the agent ids above the largest one in use, orphan references
    included (no constant shift, so a wrong remap changes the sums), and report, per table, its rows, the rows
    now referencing a renumbered agent, and the sum of the key column."""
    used = [("agents", "agent_id")] + [(c.name, fk.column) for c, fk in children_of("agents")]
    tops = reduce(DataFrame.unionByName, [t[name].agg(F.max(column).alias("top")) for name, column in used])
    top = F.coalesce(tops.agg(F.max("top")).scalar(), F.lit(0))
    mapping = t["agents"].select(
        F.col("agent_id").alias("old_key"), (top * 2 + 1 - F.col("agent_id")).alias("new_key"))
    out = rekey(t, "agents", mapping)
    parts = []
    for name, column in used:
        moved = F.col(column).between(top + 1, top * 2)
        parts.append(out[name].agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
            F.count_if(moved).alias("renumbered_references"), F.sum(column).cast("bigint").alias("key_sum")))
    return reduce(DataFrame.unionByName, parts)
