"""Row order without a task for a key: ordinals, ranks and segmented scans.

Rows are range-partitioned and sorted by the whole order (key, then order
within the key), so a key with a third of all rows lies in many consecutive
buckets.  What a row needs from its key is put together from its own bucket
and a carry table, which has two rows a bucket at most: only the first and
the last key of a bucket can go on in another one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.operators.lineage import cut

BUCKET, PLACE = "__bucket", "__place"
_LOW_BITS = 33  # monotonically_increasing_id: partition above, row below


def range_buckets(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``rows`` in the order of ``order``: plus ``__bucket``, growing along
    the order, and ``__place``, the row's number in its bucket from 0.

    The result is cut, so buckets are the same for everything that reads
    them, also after an executor is lost.  ``order`` must tell all rows
    apart where a defined order of ties is wanted."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    return cut(placed.select(*rows.columns, F.shiftright("__id", _LOW_BITS).alias(BUCKET),
                             F.col("__id").bitwiseAND((1 << _LOW_BITS) - 1).alias(PLACE)))


def bucket_starts(buckets: DataFrame) -> DataFrame:
    """(__bucket, __start): rows before each bucket.  One row a bucket, so
    the window over all of them is over as many rows as there are tasks."""
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    sizes = buckets.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    return sizes.select(BUCKET, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))


def with_ordinal(rows: DataFrame, order: Sequence[Column | str], name: str = "ordinal") -> DataFrame:
    """``rows`` plus their number from 1 in the global order, as
    ``row_number()`` over all rows would give it, without one task for all.
    An empty table gives an empty result."""
    buckets = range_buckets(rows, order)
    starts = F.broadcast(bucket_starts(buckets))  # one row a bucket
    return buckets.join(starts, BUCKET).select(*rows.columns, (F.col("__start") + F.col(PLACE) + 1).alias(name))


def segmented_scan(rows: DataFrame, key: Sequence[str], order: Sequence[Column | str], *,
                   first: Mapping[str, str] | None = None, last: Mapping[str, str] | None = None,
                   previous: Mapping[str, str] | None = None, number: str | None = None,
                   running: Mapping[str, str] | None = None) -> DataFrame:
    """``rows`` plus window columns over ``key`` in ``order``.

    ``first``, ``last`` and ``previous`` map a new column to the column whose
    first, last or preceding value it is; ``number`` is the row's number from
    1; ``running`` maps a new column to the numeric column it sums up to and
    with the row.  Null keys are a key, as in a window.  The windows run over
    (bucket, key); the carry table brings in the key's other buckets."""
    first, last, previous, running = (dict(x or {}) for x in (first, last, previous, running))
    buckets = range_buckets(rows, [*[F.col(k) for k in key], *order])
    here = Window.partitionBy(BUCKET, *key).orderBy(PLACE)
    whole, upto = (here.rowsBetween(Window.unboundedPreceding, end) for end in (Window.unboundedFollowing, Window.currentRow))
    local = buckets.select(
        "*", F.row_number().over(here).alias("__number"),
        *[F.first(c).over(whole).alias(f"__first_{n}") for n, c in first.items()],
        *[F.last(c).over(whole).alias(f"__last_{n}") for n, c in last.items()],
        *[F.lag(c).over(here).alias(f"__previous_{n}") for n, c in previous.items()],
        *[F.sum(c).over(upto).alias(f"__running_{n}") for n, c in running.items()])
    carry = _carry(buckets, key, first, last, previous, running)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in key])
    both = local.join(F.broadcast(carry), (F.col(BUCKET) == F.col("__of")) & same, "left")
    carried = F.col("__of").isNotNull()
    new = [F.when(carried, F.col(f"__c_first_{n}")).otherwise(F.col(f"__first_{n}")).alias(n) for n in first]
    new += [F.when(carried, F.col(f"__c_last_{n}")).otherwise(F.col(f"__last_{n}")).alias(n) for n in last]
    new += [F.when(carried & (F.col("__number") == 1), F.col(f"__c_previous_{n}")).otherwise(F.col(f"__previous_{n}")).alias(n)
            for n in previous]
    if number:
        new.append((F.col("__number") + F.coalesce("__c_number", F.lit(0))).alias(number))
    for n in running:
        before = F.col(f"__c_running_{n}")
        here_sum = F.col(f"__running_{n}")
        new.append(F.when(before.isNull(), here_sum).otherwise(before + F.coalesce(here_sum, F.lit(0))).alias(n))
    return both.select(*rows.columns, *new)


def _carry(buckets: DataFrame, key: Sequence[str], first, last, previous, running) -> DataFrame:
    """For the first and last key of every bucket what the key's rows in all
    buckets, or in those before, amount to: two rows a bucket at most."""
    names = [f"__key_{k}" for k in key]
    tops = F.broadcast(buckets.groupBy(BUCKET).agg(F.max(PLACE).alias("__top")))
    at_edge = (F.col(PLACE) == 0) | (F.col(PLACE) == F.col("__top"))
    edges = buckets.join(tops, BUCKET).where(at_edge).select(
        F.col(BUCKET).alias("__of"), *[F.col(k).alias(n) for k, n in zip(key, names)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names)])
    sums = buckets.join(F.broadcast(edges), (F.col(BUCKET) == F.col("__of")) & same).groupBy("__of", *names).agg(
        F.count(F.lit(1)).alias("__n"), F.min(PLACE).alias("__lo_at"), F.max(PLACE).alias("__hi_at"),
        *[F.sum(c).alias(f"__sum_{n}") for n, c in running.items()])
    # the values at both ends of each part
    values = sorted({*first.values(), *last.values(), *previous.values()})
    parts = sums
    for end in ("lo", "hi"):
        row = buckets.select(F.col(BUCKET).alias("__b"), F.col(PLACE).alias("__p"), *[F.col(v).alias(f"__{end}_{v}") for v in values])
        parts = row.join(F.broadcast(parts), (F.col("__b") == F.col("__of")) & (F.col("__p") == F.col(f"__{end}_at"))).drop("__b", "__p")
    along = Window.partitionBy(*[f"__key_{k}" for k in key]).orderBy("__of")
    whole, before = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), along.rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "__of", *[f"__key_{k}" for k in key], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__c_number"),
        *[F.first(f"__lo_{c}").over(whole).alias(f"__c_first_{n}") for n, c in first.items()],
        *[F.last(f"__hi_{c}").over(whole).alias(f"__c_last_{n}") for n, c in last.items()],
        *[F.lag(f"__hi_{c}").over(along).alias(f"__c_previous_{n}") for n, c in previous.items()],
        *[F.sum(f"__sum_{n}").over(before).alias(f"__c_running_{n}") for n in running])
