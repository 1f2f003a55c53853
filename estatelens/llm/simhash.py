"""SimHash near-duplicates: byte-position inverted index, count filter.

Fingerprints at most ``k`` bits apart differ in at most ``k`` of their eight
bytes, so they share at least ``8 - k`` positional bytes.  The index posts
distinct fingerprints under positional bytes; pairs that meet in a posting
list have their shared positional bytes tallied, pairs under the guaranteed
minimum are dropped and the rest verified bit by bit.

One byte would put 1/256 of all fingerprints in a list.  The postings are
therefore compound, over families of positions of which every pair that
reaches the minimum shares at least one: first three bytes (two groups of
four positions, any five shared positions have three in a group), for lists
that are still long five bytes, and for those 55 bits.  A list of the last
level holds at most 2**9 distinct fingerprints, whatever the data, so no
list is capped and none is unbounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.bytesops import LOWER, SPACE, chunks, spans
from estatelens.llm.components import components
from estatelens.llm.shared import BROADCAST_BYTES, cut, one_of_each, shuffle_partitions, small_or_shuffled

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Lists up to this length are paired in one task.
LIST = 256

_BYTES = (
    [c for g in ((0, 1, 2, 3), (4, 5, 6, 7)) for c in combinations(g, 3)],
    list(combinations(range(8), 5)),
)


def _byte_mask(positions) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def _octal_mask(positions) -> list[int]:
    """The five bytes, and five of the eight 3-bit groups of the others."""
    rest = [p for p in range(8) if p not in positions]
    bits = [1 << (8 * p + i) for p in rest for i in range(8)]
    groups = [sum(bits[3 * g:3 * g + 3]) for g in range(8)]
    return [_byte_mask(positions) | sum(groups[g] for g in c) for c in combinations(range(8), 5)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _longs(masks) -> Column:
    return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])


def _inside(positions) -> list[int]:
    """Five-byte masks that hold the three bytes of a long list."""
    return [_byte_mask(c) for c in _BYTES[1] if set(positions) <= set(c)]


FIRST = [_byte_mask(c) for c in _BYTES[0]]
SECOND = {_byte_mask(c): _inside(c) for c in _BYTES[0]}
THIRD = {_byte_mask(c): _octal_mask(c) for c in _BYTES[1]}


def fingerprint_bytes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: int) -> int:
    """SimHash of one document's words, given as slices of its bytes."""
    n = len(starts)
    if not n:
        return 0
    length = ends - starts
    at = np.concatenate([[0], np.cumsum(length + 1)])  # where each word starts, one space after each
    joined = np.full(at[-1], 0x20, np.uint8)
    step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    joined[np.repeat(at[:-1], length) + step] = raw[np.repeat(starts, length) + step]
    buf = joined.tobytes()
    k = min(words, n)
    digest = xxhash.xxh64_intdigest
    total = n - k + 1
    count = np.zeros(64, np.int64)
    for lo in range(0, total, 65536):
        hi = min(total, lo + 65536)
        h = np.array([digest(buf[s:e], 42) for s, e in zip(at[lo:hi].tolist(), (at[lo + k:hi + k] - 1).tolist())], dtype="<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * count > total)
    return sum(1 << int(b) for b in set_bits)


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of every row's word shingles.

    A-Z are lower-cased; words are runs without ASCII white space; shingles
    are ``words`` consecutive words joined by a space, repeats included, or
    all words if there are fewer.  Null text and text without words have
    fingerprint zero."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches):
            low = LOWER[data]
            starts, ends, first = spans(low, offsets, ~SPACE)
            fps = [fingerprint_bytes(low, starts[a:b], ends[a:b], words) for a, b in zip(first[:-1], first[1:])]
            fp = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([rows.column(0), fp], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return narrow.mapInArrow(task, f"doc_id {kind}, fp long")


def _post(fps: DataFrame, masks) -> DataFrame:
    """One posting a mask: (mask, key, fp)."""
    m = F.explode(masks).alias("mask")
    return fps.select("fp", m).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def _refine(long_lists: DataFrame, finer: dict[int, list[int]]) -> DataFrame:
    table = F.create_map(*[x for k, v in finer.items() for x in (F.lit(_signed(k)).cast("long"), _longs(v))])
    return _post(long_lists.select("fp", table[F.col("mask")].alias("masks")), F.col("masks")).distinct()


def _links(lists: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that span, in each list, what the verified pairs join:
    one from each member of a part to the part's least, so that a part is a
    star at once and its components take few rounds."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [], []
            for fps in batch.column(0):
                f = np.unique(np.array(fps.as_py(), np.int64)).view(np.uint64)
                n = len(f)
                x = f[:, None] ^ f[None, :]
                shared = (x.view(np.uint8).reshape(n, n, 8) == 0).sum(axis=2)  # tally of positional bytes
                i, j = np.nonzero(np.triu(shared >= 8 - max_bits, 1))
                near = np.bitwise_count(x[i, j]) <= max_bits
                i, j = i[near], j[near]
                root = np.arange(n)

                def find(v):
                    while root[v] != v:
                        root[v] = root[root[v]]
                        v = root[v]
                    return v

                for p, q in zip(i.tolist(), j.tolist()):
                    a, b = find(p), find(q)
                    root[max(a, b)] = min(a, b)
                signed = f.view(np.int64).tolist()
                for p in np.unique([i, j]).tolist():
                    if (q := find(p)) != p:
                        out_a.append(signed[p])
                        out_b.append(signed[q])
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return lists.select("fps").mapInArrow(task, "a long, b long")


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, longest: int = LIST) -> DataFrame:
    """Links between distinct fingerprints (column ``fp``, distinct) at most
    ``max_bits`` (1 to 3) apart.  Within a list each member of a part is
    linked to its least, so components are those of all near pairs."""
    if not 1 <= max_bits <= MAX_BITS:
        raise ValueError("the posting families guarantee a shared key for up to 3 bits")
    postings = cut(_post(fps, _longs(FIRST)))
    out = None
    for finer in (SECOND, THIRD, None):
        sizes = postings.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if finer is not None:
            long_keys = cut(sizes.where(F.col("n") > longest))
            short = postings.join(long_keys.select("mask", "key"), ["mask", "key"], "left_anti") if long_keys.count() else postings
        else:
            short = postings
        lists = (short.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1"))
        found = _links(lists, max_bits)
        out = found if out is None else out.unionByName(found)
        if finer is None or not long_keys.count():
            return out
        postings = cut(_refine(postings.join(long_keys.select("mask", "key"), ["mask", "key"]), finer))


def _named(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(__fp, least): for each of ``nodes`` (fp, least; fp distinct) the
    smallest ``least`` of its component."""
    found = cut(components(near_links(nodes.select("fp"), max_bits)))
    linked = small_or_shuffled(found, 16)
    least = linked.join(nodes, F.col("fp") == F.col("node")).groupBy(F.col("root").alias("__root")).agg(F.min("least").alias("__least"))
    least = F.broadcast(least) if found.count() * 64 <= BROADCAST_BYTES else least.repartition(shuffle_partitions(nodes))
    named = cut(found.join(least, F.col("root") == F.col("__root")).select("node", "__least"))
    return (nodes.join(small_or_shuffled(named, 64), F.col("fp") == F.col("node"), "left")
            .select(F.col("fp").alias("__fp"), F.coalesce("__least", "least").alias("least")))


def simhash_components(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row: ``component_id`` is the
    smallest doc_id reachable over links of at most ``max_bits`` bits.

    Equal fingerprints are one node, whatever their number, so copies are
    never paired.  Null and empty texts share fingerprint zero.  Rows that
    repeat an id are returned as often as they occur.  Null ids take part
    but never name a component unless it holds no other id.  An empty table
    gives an empty result.
    """
    fps = cut(fingerprints(docs, words, id_col, text_col))
    member = _named(cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least"))), max_bits)
    return fps.join(member, F.col("fp") == F.col("__fp")).select("doc_id", "fp", F.col("least").alias("component_id"))


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_dedup(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` of each group of near-duplicates, all columns kept.

    It is a row with the smallest doc_id of the group, a null being larger
    than any id; of several with that id, one by hash of the text, and of
    rows equal in id and text one by hash of the row.  Rows are dropped by
    id and text, so an id on rows of different groups is judged in each.
    """
    ident, key = F.col("`doc_id`"), F.xxhash64(F.col("`text`"))
    rows = docs.select(F.struct(ident.alias("id"), key.alias("key")).alias("doc_id"), F.col("`text`").alias("text"))
    fps = cut(fingerprints(rows, words).select(F.struct(F.col("doc_id.id").isNull().alias("none"), "doc_id.*").alias("row"), "fp"))
    member = _named(cut(fps.groupBy("fp").agg(F.min("row").alias("least"))), max_bits)
    judged = cut(fps.join(member, F.col("fp") == F.col("__fp")).select(
        F.col("row.id").alias("__id"), F.col("row.key").alias("__key"), F.col("row").eqNullSafe(F.col("least")).alias("kept")))
    gone = cut(judged.where("not kept").select("__id", "__key").distinct())
    again = cut(judged.where("kept").groupBy("__id", "__key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__id", "__key"))
    same = ident.eqNullSafe(F.col("__id")) & (key == F.col("__key"))
    left = docs.join(small_or_shuffled(gone, 64), same, "left_anti")
    if not again.count():
        return left
    repeated = small_or_shuffled(again, 64)
    return left.join(repeated, same, "left_anti").unionByName(one_of_each(left.join(repeated, same, "left_semi"), ident, key))
