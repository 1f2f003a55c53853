"""Exact deduplication: two-pass Bloom filtering.

Pass one marks the filter slots that at least two rows hit; pass two tests
every row against those slots.  A text that occurs twice hits all its slots
twice, so rows that fail the test are unique and pass straight through.
Only the rest shuffle, and they are grouped exactly by SHA-256.  Everything
is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.shared import cut, lower_ascii, one_of_each, replace_columns, small_or_shuffled

#: Filter bits per row, and the largest filter: 2**29 bits are 64 MB.  Past
#: 2**25 rows the filter gets denser: more unique rows shuffle, the result
#: stays the same.
BITS_PER_ROW = 16
MAX_FILTER_BITS = 1 << 29
_BLOCK_BITS = 15  # a bitmap of Spark's bitmap functions: 32,768 bits
OUT = ("keep_id", "group_size", "kept", "text_sha256")


def _filter_bits(n_rows: int) -> int:
    bits = 1 << _BLOCK_BITS
    while bits < min(BITS_PER_ROW * n_rows, MAX_FILTER_BITS):
        bits *= 2
    return bits


def _slots(sha: Column, bits: int) -> tuple[Column, list[Column]]:
    """Block of the filter, and two bit positions in it."""
    h = F.xxhash64(sha)
    block = F.pmod(F.shiftrightunsigned(h, 32), F.lit(bits >> _BLOCK_BITS)).cast("long")
    low = F.lit((1 << _BLOCK_BITS) - 1).cast("long")
    return block, [h.bitwiseAND(low), F.shiftrightunsigned(h, _BLOCK_BITS).bitwiseAND(low)]


def repeat_filter(hashed: DataFrame, bits: int) -> DataFrame:
    """(block, bitmap): the bits that two rows or more have set.

    Counts are combined map-side before the shuffle, so a text that a third
    of the rows share arrives as one row a task."""
    block, pos = _slots(F.col("text_sha256"), bits)
    hits = hashed.select(block.alias("block"), F.explode(F.array_distinct(F.array(*pos))).alias("pos"))
    twice = hits.groupBy("block", "pos").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    return twice.groupBy("block").agg(F.expr("bitmap_construct_agg(pos)").alias("bitmap"))


def _bit(bitmap: Column, pos: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(pos, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(pos, F.lit(8)).cast("int")) == 1


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``keep_id`` (largest id among equal texts),
    ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal if they are identical after lower-casing A-Z.  Null text
    counts as empty.  Rows that repeat an id keep their own row; each is kept
    if its id is the largest of the group.  A null id loses against any
    other; if all ids of a group are null, all its rows are kept.  An empty
    table gives an empty result.  Input columns named like an added column
    are replaced.
    """
    docs = replace_columns(docs, *OUT)
    sha = F.sha2(lower_ascii(F.col(f"`{text_col}`")), 256)
    hashed = docs.withColumn("text_sha256", sha)
    bits = _filter_bits(docs.select(F.lit(1)).count())
    block, pos = _slots(F.col("text_sha256"), bits)
    twice = cut(repeat_filter(hashed.select("text_sha256"), bits))  # at most MAX_FILTER_BITS / 8 bytes
    probe = F.broadcast(twice.select(F.col("block").alias("__block"), F.col("bitmap").alias("__bitmap")))
    tested = (hashed.join(probe, block == F.col("__block"), "left")
              .withColumn("__again", F.coalesce(_bit(F.col("__bitmap"), pos[0]) & _bit(F.col("__bitmap"), pos[1]), F.lit(False)))
              .drop("__block", "__bitmap"))
    ident = F.col(f"`{id_col}`")
    alone = tested.where(~F.col("__again")).drop("__again")
    again = tested.where("__again").drop("__again")
    groups = cut(again.groupBy(F.col("text_sha256").alias("__sha"))
                 .agg(F.max(ident).alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    grouped = (again.join(small_or_shuffled(groups, 200), F.col("text_sha256") == F.col("__sha"))
               .withColumn("kept", ident.eqNullSafe(F.col("keep_id"))))
    order = [*[F.col(f"`{c}`") for c in docs.columns], F.col("keep_id"), F.col("group_size"), F.col("kept"), F.col("text_sha256")]
    single = alone.withColumns({"keep_id": ident, "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    return single.select(*order).unionByName(grouped.select(*order))


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, of the rows that
    :func:`exact_dedup` keeps, with the columns of ``docs``."""
    kept = exact_dedup(docs).where("kept")
    names = [F.col(f"`{c}`") for c in docs.columns]
    again = cut(kept.where("group_size > 1").groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                .select(F.col("text_sha256").alias("__sha")))
    if not again.count():
        return kept.select(*names)
    repeated, same = small_or_shuffled(again, 200), F.col("text_sha256") == F.col("__sha")
    one = one_of_each(kept.join(repeated, same, "left_semi"), F.col("text_sha256"))
    return kept.join(repeated, same, "left_anti").unionByName(one).select(*names)
