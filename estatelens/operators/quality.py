"""Data-quality jobs: the declared integrity rules, run over whole tables.

A relational database enforces these row by row at insert time and stops at
the first failure.  Here each rule family is one set-based Spark job that
reports every violation:

* row rules (NOT NULL, CHECK domain lists, CHECK ranges and cross-column
  predicates, VARCHAR lengths, NUMERIC precision) - one scan per table, all
  rules evaluated in the same projection;
* key rules (PRIMARY KEY and UNIQUE) - an aggregation whose parts follow
  the number of rows; a key that holds a third of the rows streams through
  one task and takes one row of its memory;
* foreign keys - anti joins on non-NULL values only.

As in SQL, a CHECK whose predicate is NULL passes, and NULLs never collide
in a UNIQUE key.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.operators.lineage import BROADCAST_BYTES, cut
from estatelens.schemas import LOAD_ORDER, TABLES, Table

Tables = Mapping[str, DataFrame]

#: Rows that one part of a grouping or join of all tables gets on average.
ROWS_A_PART = 500_000
#: What a key takes in a broadcast table, in bytes.
KEY_BYTES = 64


def _fails(pred: Column) -> Column:
    """TRUE only when the row definitely breaks the rule (NULL passes)."""
    return F.coalesce(pred, F.lit(False))


def row_rules(table: Table, df: DataFrame | None = None) -> list[tuple[str, Column]]:
    """(rule_id, violated?) for every row-level rule of ``table``.

    When ``df`` is given and a column arrives with another type than
    declared (raw input before conforming), a NUMERIC precision rule checks
    that the value fits the declared ``decimal(p,s)``.
    """
    rules: list[tuple[str, Column]] = []
    raw_types = {f.name: f.dataType for f in df.schema.fields} if df is not None else {}
    for c in table.columns:
        col = F.col(c.name)
        if not c.nullable:
            rules.append((f"not_null:{c.name}", col.isNull()))
        if c.domain:
            rules.append((f"domain:{c.name}", _fails(~col.isin(*c.domain))))
        if c.max_len:
            rules.append((f"length:{c.name}", _fails(F.char_length(col) > c.max_len)))
        if isinstance(c.dtype, T.DecimalType) and c.name in raw_types and raw_types[c.name] != c.dtype:
            rules.append(
                (f"precision:{c.name}", col.isNotNull() & col.try_cast(c.dtype).isNull())
            )
    for chk in table.checks:
        rules.append((f"check:{chk.rule_id}", _fails(~F.expr(chk.predicate))))
    return rules


def split(df: DataFrame, table: str | Table, keep_tagged: bool = False):
    """(good rows, rejected rows + ``failed_rules`` array) by row rules.

    With ``keep_tagged`` returns (all rows with ``failed_rules``, None)."""
    t = TABLES[table] if isinstance(table, str) else table
    rules = row_rules(t, df)
    failed = F.filter(
        F.array(*[F.when(v, F.lit(rid)) for rid, v in rules]), lambda x: x.isNotNull()
    )
    tagged = df.withColumn("failed_rules", failed)
    if keep_tagged:
        return tagged, None
    good = tagged.where(F.size("failed_rules") == 0).drop("failed_rules")
    bad = tagged.where(F.size("failed_rules") > 0)
    return good, bad


def row_rule_counts(df: DataFrame, table: str | Table) -> DataFrame:
    """One row per row rule: (table_name, rule_id, violations), one scan."""
    t = TABLES[table] if isinstance(table, str) else table
    rules = row_rules(t, df)
    counts = df.agg(*[F.count_if(v).alias(f"r{i}") for i, (_, v) in enumerate(rules)])
    pairs = ", ".join(f"'{rid}', r{i}" for i, (rid, _) in enumerate(rules))
    return counts.select(
        F.lit(t.name).alias("table_name"),
        F.expr(f"stack({len(rules)}, {pairs}) AS (rule_id, violations)"),
    ).select("table_name", "rule_id", F.col("violations").cast("bigint"))


def key_rules(table: Table) -> list[tuple[str, tuple[str, ...]]]:
    """(rule_id, key columns) of the PRIMARY KEY and every UNIQUE."""
    return [(f"primary_key:{table.primary_key}", (table.primary_key,))] + [
        (f"unique:{'+'.join(u)}", tuple(u)) for u in table.unique
    ]


def _duplicate_group_sizes(df: DataFrame, table: Table) -> DataFrame:
    """(table_name, rule_id, n) for every key value held by n > 1 rows."""
    parts = []
    for rid, cols in key_rules(table):
        nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        parts.append(
            df.where(nonnull).groupBy(*cols).count().where(F.col("count") > 1).select(
                F.lit(table.name).alias("table_name"), F.lit(rid).alias("rule_id"),
                F.col("count").alias("n"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _with_zeros(spark, rule_ids: list[tuple[str, str]], counts: DataFrame) -> DataFrame:
    """Attach the counts to the full rule list (rules without rows get 0)."""
    catalog = spark.createDataFrame(rule_ids, "table_name string, rule_id string")
    return catalog.join(counts, ["table_name", "rule_id"], "left").select(
        "table_name", "rule_id", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")
    )


def key_rule_counts(df: DataFrame, table: str | Table) -> DataFrame:
    """Rows that share a PRIMARY KEY / UNIQUE value with another row."""
    t = TABLES[table] if isinstance(table, str) else table
    counts = _duplicate_group_sizes(df, t).groupBy("table_name", "rule_id").agg(
        F.sum("n").alias("violations"))
    return _with_zeros(df.sparkSession, [(t.name, rid) for rid, _ in key_rules(t)], counts)


def duplicate_keys(df: DataFrame, cols: tuple[str, ...] | list[str]) -> DataFrame:
    """The rows whose (non-NULL) key occurs more than once.

    Duplicated keys are found by an aggregation and joined back; a hot key
    is split by AQE's skew-join handling instead of landing in one task."""
    cols = list(cols)
    nonnull = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    dups = nonnull.groupBy(*cols).count().where(F.col("count") > 1).select(*cols)
    return nonnull.join(dups, cols, "left_semi")


def orphans(t: Tables, table: str | Table, column: str) -> DataFrame:
    """Rows of ``table`` whose non-NULL ``column`` has no parent row."""
    tb = TABLES[table] if isinstance(table, str) else table
    fk = next(f for f in tb.foreign_keys if f.column == column)
    child = t[tb.name].where(F.col(column).isNotNull())
    parent = t[fk.parent].select(F.col(fk.parent_column).alias("__pk"))
    return child.join(parent, F.col(column) == F.col("__pk"), "left_anti")


def _fk_rule_id(fk) -> str:
    return f"foreign_key:{fk.column}->{fk.parent}"


def foreign_key_counts(t: Tables, table: str | Table) -> DataFrame | None:
    tb = TABLES[table] if isinstance(table, str) else table
    if not tb.foreign_keys:
        return None
    orphan_rows = reduce(DataFrame.unionByName, [
        orphans(t, tb, fk.column).select(
            F.lit(tb.name).alias("table_name"), F.lit(_fk_rule_id(fk)).alias("rule_id"))
        for fk in tb.foreign_keys
    ])
    counts = orphan_rows.groupBy("table_name", "rule_id").agg(F.count(F.lit(1)).alias("violations"))
    spark = t[tb.name].sparkSession
    return _with_zeros(spark, [(tb.name, _fk_rule_id(fk)) for fk in tb.foreign_keys], counts)


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def row_rule_report(t: Tables, as_of=None) -> DataFrame:
    """Row-rule violation counts for all 14 tables."""
    return _union(row_rule_counts(t[tb.name], tb) for tb in LOAD_ORDER)


def _parts(rows: int) -> int:
    """Parts of a shuffle of so many rows: each part stays as small on any
    input, whatever the session's number of shuffle partitions."""
    return 1 + rows // ROWS_A_PART


def _foreign_key_ids(tb: Table) -> list[str]:
    return [_fk_rule_id(fk) for fk in tb.foreign_keys]


def _unique_ids(tb: Table) -> list[str]:
    return [rid for rid, _ in key_rules(tb)[1:]]


def _primary_id(tb: Table) -> list[str]:
    return [key_rules(tb)[0][0]]


def _by_table(values: list[list], at: Column) -> Column:
    """``values[tab][at]``, a lookup in literals."""
    return F.element_at(F.element_at(F.array(*[F.array(*[F.lit(v) for v in x]) for x in values]), F.col("tab") + 1), at + 1)


def _named(rows: DataFrame, kind, at: Column, *columns: str) -> DataFrame:
    """(table_name, rule_id, ``columns``) of rows with a table number, where
    ``at`` is the rule's place within the table."""
    ids = [kind(tb) or [None] for tb in LOAD_ORDER]
    return rows.select(F.element_at(F.array(*[F.lit(tb.name) for tb in LOAD_ORDER]), F.col("tab") + 1).alias("table_name"),
                       _by_table(ids, at).alias("rule_id"), *columns)


def _scanned(t: Tables, row_rules_too: bool = False, keys: bool = False, foreign_keys: bool = False) -> tuple[DataFrame, list[list[str]]]:
    """What the rules need of all tables, each scanned once, and cut: a row
    for every row, with the table's number ``tab``, its primary ``key``, the
    UNIQUE values ``uniques`` as text (NULL unless all columns are filled),
    the references ``refs`` and ``broken``, a bit for every broken row rule
    (at most 63 a table).  Also the row rules' ids, table by table."""
    parts, ids = [], []
    for i, tb in enumerate(LOAD_ORDER):
        df = t[tb.name]
        columns = [F.lit(i).alias("tab"), F.col(tb.primary_key).cast("bigint").alias("key")]
        if keys:
            uniques = []
            for _, cols in key_rules(tb)[1:]:
                filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
                uniques.append(F.when(filled, F.col(cols[0]).cast("string") if len(cols) == 1 else F.to_json(F.struct(*cols))))
            columns.append((F.array(*uniques) if uniques else F.lit(None).cast("array<string>")).alias("uniques"))
        if foreign_keys:
            refs = [F.col(fk.column).cast("bigint") for fk in tb.foreign_keys]
            columns.append((F.array(*refs) if refs else F.lit(None).cast("array<bigint>")).alias("refs"))
        if row_rules_too:
            rules = row_rules(tb, df)
            ids.append([rid for rid, _ in rules])
            bits = [F.when(v, F.lit(1 << b)).otherwise(F.lit(0)).cast("bigint") for b, (_, v) in enumerate(rules)]
            columns.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias("broken"))
        parts.append(df.select(*columns))
    return cut(reduce(DataFrame.unionByName, parts)), ids


def _shared_keys(scanned: DataFrame, rows: int) -> DataFrame:
    """(tab, key, n) of primary keys that n > 1 rows have."""
    keys = scanned.where(F.col("key").isNotNull()).select("tab", "key")
    return keys.repartition(_parts(rows), "tab", "key").groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _unique_values(scanned: DataFrame, rows: int) -> DataFrame:
    """(tab, at, value, key) of all filled UNIQUE values, dealt by value."""
    tabs = [i for i, tb in enumerate(LOAD_ORDER) if tb.unique]
    values = scanned.where(F.col("tab").isin(tabs)).select("tab", "key", F.posexplode("uniques").alias("at", "value"))
    return values.where(F.col("value").isNotNull()).repartition(_parts(rows), "tab", "at", "value")


def _shared_uniques(scanned: DataFrame, rows: int) -> DataFrame:
    """(tab, at, value, n) of UNIQUE values that n > 1 rows have."""
    return _unique_values(scanned, rows).groupBy("tab", "at", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _orphan_refs(scanned: DataFrame) -> DataFrame:
    """(tab, key, at) of references whose value is no primary key of the
    parent.  The keys of small parents are broadcast; the others are hashed,
    part by part, and the references stream past them, so a value that many
    rows refer to takes time in one task but no memory."""
    number = {tb.name: i for i, tb in enumerate(LOAD_ORDER)}
    parents = [[number[fk.parent] for fk in tb.foreign_keys] or [None] for tb in LOAD_ORDER]
    sizes = {r.tab: r["count"] for r in scanned.groupBy("tab").count().collect()}
    small, room = [], BROADCAST_BYTES // KEY_BYTES
    for p in sorted({p for x in parents for p in x if p is not None}, key=lambda p: sizes.get(p, 0)):
        room -= sizes.get(p, 0)
        if room < 0:
            break
        small.append(p)
    known = scanned.where(F.col("key").isNotNull()).select(F.col("tab").alias("parent"), F.col("key").alias("value"))
    tabs = [i for i, tb in enumerate(LOAD_ORDER) if tb.foreign_keys]
    refs = scanned.where(F.col("tab").isin(tabs)).select("tab", "key", F.posexplode("refs").alias("at", "value")).where(
        F.col("value").isNotNull()).withColumn("parent", _by_table(parents, F.col("at")))
    same, out = ["parent", "value"], []
    others = sorted({p for x in parents for p in x if p is not None} - set(small))
    if small:
        out.append(refs.where(F.col("parent").isin(small)).join(F.broadcast(known.where(F.col("parent").isin(small))), same, "left_anti"))
    if others:
        n = _parts(sum(sizes.values()))
        keys = known.where(F.col("parent").isin(others)).repartition(n, *same).distinct().withColumn("found", F.lit(True))
        # an outer join: an anti join would be pushed below the repartitioning
        dealt = refs.where(F.col("parent").isin(others)).repartition(n, *same)
        out.append(dealt.join(keys.hint("shuffle_hash"), same, "left").where(F.col("found").isNull()).drop("found"))
    return _union(out).select("tab", "key", "at")


def key_rule_report(t: Tables, as_of=None) -> DataFrame:
    """PRIMARY KEY / UNIQUE violation counts for all 14 tables: one scan of
    each table, one grouping of all primary keys and one of all others."""
    scanned, _ = _scanned(t, keys=True)
    rows = scanned.count()
    counts = _union([_named(_shared_keys(scanned, rows), _primary_id, F.lit(0), "n"),
                     _named(_shared_uniques(scanned, rows), _unique_ids, F.col("at"), "n")])
    rules = [(tb.name, rid) for tb in LOAD_ORDER for rid, _ in key_rules(tb)]
    return _with_zeros(t["offices"].sparkSession, rules, counts.groupBy("table_name", "rule_id").agg(F.sum("n").alias("violations")))


def foreign_key_report(t: Tables, as_of=None) -> DataFrame:
    """Orphan counts for all 19 foreign keys: one scan of each table, then
    anti joins of all references with all primary keys."""
    scanned, _ = _scanned(t, foreign_keys=True)
    orphan_rows = _named(_orphan_refs(scanned), _foreign_key_ids, F.col("at"))
    counts = orphan_rows.groupBy("table_name", "rule_id").agg(F.count(F.lit(1)).alias("violations"))
    rules = [(tb.name, _fk_rule_id(fk)) for tb in LOAD_ORDER for fk in tb.foreign_keys]
    return _with_zeros(t["offices"].sparkSession, rules, counts)


def violations(t: Tables, table: str | Table) -> DataFrame:
    """Every violating row of ``table``: (table_name, rule_id, key).

    All row rules are judged in one scan; each key and each foreign key
    reads only its own columns and the primary key."""
    tb = TABLES[table] if isinstance(table, str) else table
    df = t[tb.name]
    pk = F.col(tb.primary_key).cast("bigint").alias("key")
    tagged, _ = split(df, tb, keep_tagged=True)
    parts = [tagged.select(F.explode("failed_rules").alias("rule_id"), pk)]
    for rid, cols in key_rules(tb):
        narrow = df.select(*dict.fromkeys([tb.primary_key, *cols]))
        parts.append(duplicate_keys(narrow, cols).select(F.lit(rid).alias("rule_id"), pk))
    for fk in tb.foreign_keys:
        parts.append(orphans(t, tb, fk.column).select(F.lit(_fk_rule_id(fk)).alias("rule_id"), pk))
    return _union(parts).select(F.lit(tb.name).alias("table_name"), "rule_id", "key")


def _repeated(groups: DataFrame) -> DataFrame:
    """``groups`` with a row for each of their n rows."""
    blocks = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(n - 1) div 1024"))))
    return blocks.withColumn("one", F.explode(F.array_repeat(F.lit(1), F.least(F.lit(1024), F.col("n") - F.col("block") * 1024).cast("int"))))


def violation_report(t: Tables, as_of=None) -> DataFrame:
    """Every row of the 14 tables that breaks a rule, with the rule: one scan
    of each table, then one grouping of all primary keys, one of all UNIQUE
    values and anti joins of all references over what the scans wrote."""
    scanned, row_ids = _scanned(t, row_rules_too=True, keys=True, foreign_keys=True)
    rows = scanned.count()
    broken = scanned.where(F.col("broken") != 0).select("tab", "key", "broken", F.explode(
        F.sequence(F.lit(0), F.lit(max(map(len, row_ids)) - 1))).alias("at")).where(F.expr("shiftright(broken, at) & 1 = 1"))
    number = {tb.name: i for i, tb in enumerate(LOAD_ORDER)}
    uniques = _unique_values(scanned, rows).join(_shared_uniques(scanned, rows).hint("shuffle_hash"), ["tab", "at", "value"])
    return _union([
        _named(broken, lambda tb: row_ids[number[tb.name]], F.col("at"), "key"),
        _named(_repeated(_shared_keys(scanned, rows)), _primary_id, F.lit(0), "key"),
        _named(uniques, _unique_ids, F.col("at"), "key"),
        _named(_orphan_refs(scanned), _foreign_key_ids, F.col("at"), "key"),
    ])


def apply_defaults(df: DataFrame, table: str | Table, load_ts=None) -> DataFrame:
    """Fill DEFAULT now()/CURRENT_DATE columns that arrive NULL or missing."""
    t = TABLES[table] if isinstance(table, str) else table
    now = F.lit(str(load_ts)).cast("timestamp_ntz") if load_ts is not None else F.localtimestamp()
    today = now.cast("date")
    for c in t.columns:
        if c.default is None:
            continue
        fill = now if c.default == "now" else today
        cur = F.col(c.name) if c.name in df.columns else F.lit(None)
        df = df.withColumn(c.name, F.coalesce(cur.cast(c.dtype), fill.cast(c.dtype)))
    return df
