"""Substring deduplication with longest-previous-factor arrays, on bytes.

A byte goes if a string of ``window`` bytes around it also starts earlier.
In suffix order, the earlier occurrence that shares most with a suffix is at
its previous or its next smaller position; if the longer of the two shares
``window`` bytes or more, the suffix repeats something earlier.

Only suffixes that can repeat are ordered.  Every window is represented by
its minimizer, the least hash of its grams; equal windows have equal
minimizers.  Minimizers that occur once are put aside with a Bloom filter of
bounded size.  Runs of windows with the same minimizer travel as one string
to the task that orders them, so equal windows meet, at a few bytes each.
There a longest-previous-factor array is made: from the suffix order, the
common prefixes of neighbours in it, and the previous and next smaller
positions.  Lengths are counted up to ``window``, which is what decides.
Inside a chunk of documents all but the first of equal windows, found by a
rolling hash and compared byte by byte, are settled before the shuffle: what
a third of the documents share arrives as one string a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.bytesops import Filter, Rolling, byte_values, chunks, covered, runs
from estatelens.llm.shared import cut, small_or_shuffled
from estatelens.llm.substring_dedup import build_filter, copies, key_of, merged_runs, run_pairs, with_copies

WINDOW = 100
GRAM = 32
#: String bytes ordered at a time.
GROUP = 1 << 20
_LOW = np.uint64(0xFFFFFFFF)


class Minimizers:
    """Window starts of a chunk and the place of each one's minimizer: the
    gram with the least hash (32 bits), the leftmost of equals."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        self.roll = Rolling(byte_values(data))
        g = np.arange(max(0, len(data) - gram + 1))
        self.gram = self.roll(g, g + gram)
        least = (self.gram & ~_LOW) | g.astype(np.uint64)
        have, need = 1, window - gram + 1
        while 2 * have <= need:
            least = np.minimum(least[:-have], least[have:]) if len(least) > have else least[:0]
            have *= 2
        if have < need:
            d = need - have
            least = np.minimum(least[:-d], least[d:]) if len(least) > d else least[:0]
        self.start_of = np.repeat(offsets[:-1], np.diff(offsets))
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data)) >= window
        self.starts = np.flatnonzero(room)
        self.place = (least[self.starts] & _LOW).astype(np.int64)


def _repeated_minimizers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in chunks(batches):
            m = Minimizers(data, offsets, window, gram)
            place = m.place[np.concatenate([[True], m.place[1:] != m.place[:-1]])] if len(m.place) else m.place
            u, n = np.unique(m.gram[place], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], names=["h", "n"])

    found = docs.select("text").mapInArrow(task, "h long, n long")
    return found.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")


def _same_bytes(data: np.ndarray, at: np.ndarray, other: np.ndarray, window: int) -> bool:
    """Whether the windows at ``at`` (ascending) and ``other`` are equal.
    Where both go on from the window before, only the new byte is compared."""
    on = np.zeros(len(at), bool)
    on[1:] = (np.diff(at) == 1) & (np.diff(other) == 1)
    a, b = at[~on], other[~on]
    return bool((data[at + window - 1] == data[other + window - 1]).all()) and all(
        bool((data[a + k] == data[b + k]).all()) for k in range(window - 1))


_PART = "doc_id long, key long, first int, last int, h long, string binary"


def _strings(docs: DataFrame, repeated, window: int, gram: int) -> DataFrame:
    """Rows without ``h``: windows (first to last) that repeat an earlier one
    of the same chunk.  Rows with ``h``: a run of other windows that share a
    minimizer, as the string they cover."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: Filter = repeated.value
        for rows, data, offsets in chunks(batches, order=[("doc_id", "ascending"), ("key", "ascending")]):
            m = Minimizers(data, offsets, window, gram)
            if not len(m.starts):
                continue
            again = np.zeros(len(data), bool)
            places = np.unique(m.place)
            again[places] = f.has(m.gram[places])
            sel = again[m.place]
            at, place = m.starts[sel], m.place[sel]
            if not len(at):
                continue
            ids, keys = rows.column(0), rows.column(1).to_numpy()
            same = np.zeros(rows.num_rows, bool)  # rows that repeat the row before them
            if rows.num_rows > 1:
                low = np.where(ids.is_null().to_numpy(zero_copy_only=False), np.iinfo(np.int64).max, ids.fill_null(0).to_numpy())
                same[1:] = (low[1:] == low[:-1]) & (keys[1:] == keys[:-1])
            fresh = ~same[m.doc[at]]
            at, place = at[fresh], place[fresh]
            _, one, back = np.unique(m.roll(at, at + window), return_index=True, return_inverse=True)
            later = one[back] != np.arange(len(at))
            if not _same_bytes(data, at[later], at[one[back[later]]], window):  # a hash that two strings share
                said = np.array([data[i:i + window].tobytes() for i in at.tolist()], object)
                _, one, back = np.unique(said, return_index=True, return_inverse=True)
                later = one[back] != np.arange(len(at))
            s, e = runs(at[later])
            at, place = at[~later], place[~later]
            brk = np.flatnonzero((np.diff(at) != 1) | (np.diff(place) != 0)) + 1
            a = at[np.concatenate([[0], brk])] if len(at) else at
            b = at[np.concatenate([brk, [len(at)]]) - 1] if len(at) else at
            h = m.gram[place[np.concatenate([[0], brk])]] if len(at) else m.gram[:0]
            who = pa.array(np.concatenate([m.doc[s], m.doc[a]]))
            first = np.concatenate([s - m.start_of[s], a - m.start_of[a]]).astype(np.int32)
            last = np.concatenate([e - m.start_of[s], b - m.start_of[a]]).astype(np.int32)
            blank = np.arange(len(first)) < len(s)
            hh = np.concatenate([np.zeros(len(s), np.uint64), h]).view(np.int64)
            strings = [None] * len(s) + [data[i:j].tobytes() for i, j in zip(a.tolist(), (b + window).tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(who), rows.column(1).take(who), pa.array(first), pa.array(last), pa.array(hh, mask=blank),
                 pa.array(strings, pa.binary())], names=["doc_id", "key", "first", "last", "h", "string"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "key", "text").mapInArrow(task, _PART)


def suffix_ranks(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Ranks, in lexicographic order, of the strings of ``length`` bytes that
    start at ``at``; equal strings share a rank.  Prefix doubling: ranks of
    8 bytes, then of two to four neighbours at a time."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n + length, np.uint64)
    for k in range(min(8, length)):
        key |= padded[k:k + n + length] << np.uint64(56 - 8 * k)
    have = min(8, length)
    rank = np.unique(key, return_inverse=True)[1]
    while have < length:
        ways = 4 if rank.max() < (1 << 15) else 3 if rank.max() < 1 << 20 else 2
        step = min(have, -(-(length - have) // (ways - 1)))  # the parts overlap where the length asks for it
        shifts = [min(step * i, length - have) for i in range(ways)]
        final = shifts[-1] + have >= length
        where = at if final else np.arange(n)
        top = int(rank.max()) + 2
        key = np.zeros(len(where), np.int64)
        for s in shifts:
            i = where + s
            key = key * top + np.where(i < len(rank), rank[np.minimum(i, len(rank) - 1)] + 1, 0)
        rank = np.unique(key, return_inverse=True)[1]
        have += shifts[-1]
        if final:
            return rank
    return np.unique(rank[at], return_inverse=True)[1]


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many bytes, ``most`` at most, the suffixes at ``a`` and ``b`` have
    in common; eight are compared at a time."""
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)]).astype(np.uint64)
    eight = np.zeros(len(text) + most + 8, np.uint64)
    for k in range(8):
        eight |= padded[k:k + len(eight)] << np.uint64(56 - 8 * k)
    out = np.full(len(a), most)
    live = np.arange(len(a))
    for at in range(0, most, 8):
        x = eight[a[live] + at] ^ eight[b[live] + at]
        differ = x != 0
        equal = sum(((x[differ] >> np.uint64(64 - 8 * k)) == 0).astype(np.int64) for k in range(1, 8))
        out[live[differ]] = np.minimum(at + equal, most)
        live = live[~differ]
    return out


def _nearest_smaller(position: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each place: the common prefix with the nearest place to its left
    that has a smaller position, 0 without one.  ``lcp`` is that with the
    place before.  All places look further left at once, each by as far as
    the place it looks at has come."""
    at, shared = np.arange(len(position)) - 1, lcp.copy()

    def looking(i: np.ndarray) -> np.ndarray:
        return i[(at[i] >= 0) & (position[np.maximum(at[i], 0)] >= position[i])]

    live = looking(np.arange(len(position)))
    while len(live):
        j = at[live]
        shared[live] = np.minimum(shared[live], shared[j])
        at[live] = at[j]
        live = looking(live)
    shared[at < 0] = 0
    return shared


def previous_factor(text: np.ndarray, at: np.ndarray, rank: np.ndarray, most: int, *position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the suffixes at ``at`` (ties by position), and the
    longest-previous-factor array along it: the length, up to ``most``, of
    the longest prefix of a suffix that also starts at a smaller position.

    The suffix that shares most with it and starts earlier is at its previous
    or its next smaller position in suffix order.  ``rank`` orders the
    suffixes by their first ``most`` bytes; suffixes at one position (the
    last of ``position`` varying fastest) are not earlier than each other."""
    order = np.lexsort((*reversed(position), rank))
    if not len(order):
        return order, np.zeros(0, np.int64)
    r, a = rank[order], at[order]
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = most
    new = 1 + np.flatnonzero(r[1:] != r[:-1])
    lcp[new] = common_prefix(text, a[new - 1], a[new], most)
    by_place = np.lexsort(tuple(reversed(position)))
    step = np.logical_or.reduce([p[by_place][1:] != p[by_place][:-1] for p in position])
    place = np.empty(len(order), np.int64)
    place[by_place] = np.concatenate([[0], np.cumsum(step)])
    place = place[order]
    left = _nearest_smaller(place, lcp)
    right = _nearest_smaller(place[::-1], np.concatenate([[0], lcp[1:][::-1]]))[::-1]
    return order, np.maximum(left, right)


def _later(t: pa.Table, window: int) -> tuple[np.ndarray, ...]:
    """Windows of the strings, and which repeat an earlier one."""
    strings = t.column("string").combine_chunks()
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    text = np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    n = np.diff(offsets) - window + 1
    row = np.repeat(np.arange(len(n)), n)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = offsets[row] + inside
    last = np.iinfo(np.int64).max
    doc = t.column("doc_id").fill_null(last).to_numpy()[row]
    key = t.column("key").to_numpy()[row]
    start = t.column("first").to_numpy().astype(np.int64)[row] + inside
    order, length = previous_factor(text, at, suffix_ranks(text, at, window), window, doc, key, start)
    return order, length >= window, row, inside, at, text, start


def _distinct(t: pa.Table, window: int) -> tuple[pa.Table, pa.RecordBatch]:
    """The first row of each string, and the windows of the others: rows are
    in order of position within a minimizer, so all of those are later."""
    code = t.column("string").combine_chunks().dictionary_encode().indices.to_numpy()
    _, one, back = np.unique(code, return_index=True, return_inverse=True)
    last = np.iinfo(np.int64).max
    ids = [t.column("doc_id").fill_null(last).to_numpy(), t.column("key").to_numpy(), t.column("first").to_numpy()]
    twice = ~np.logical_and.reduce([x == x[one[back]] for x in ids])
    rest = t.filter(pa.array(twice))
    first = rest.column("first").to_numpy()
    n = pc.binary_length(rest.column("string")).to_numpy().astype(np.int32)
    gone = pa.RecordBatch.from_arrays(
        [rest.column("doc_id").combine_chunks(), rest.column("key").combine_chunks(), pa.array(first), pa.array(first + n - np.int32(window))],
        names=["doc_id", "key", "first", "last"])
    return t.take(pa.array(np.sort(one))), gone


def _repeats(strings: DataFrame, window: int) -> DataFrame:
    """Windows (first to last) that repeat an earlier one of another chunk.

    Strings arrive sorted by minimizer and are ordered in groups of whole
    minimizers.  One with more strings than a group holds is worked through
    piece by piece: strings with a window that is the earliest so far are
    carried on, and the next piece is at least as long as what is carried."""

    def settle(t: pa.Table, carry: bool = False) -> tuple[pa.RecordBatch, pa.Table | None]:
        t, same = _distinct(t, window)
        order, later, row, inside, at, text, start = _later(t, window)
        gone = order[later]
        gone = gone[np.lexsort((start[gone], row[gone]))]
        brk = np.flatnonzero((np.diff(gone) != 1) | (np.diff(row[gone]) != 0)) + 1 if len(gone) else gone
        a = gone[np.concatenate([[0], brk])] if len(gone) else gone
        b = gone[np.concatenate([brk, [len(gone)]]) - 1] if len(gone) else gone
        who = pa.array(row[a])
        out = pa.RecordBatch.from_arrays(
            [t.column("doc_id").combine_chunks().take(who), t.column("key").combine_chunks().take(who),
             pa.array(start[a].astype(np.int32)), pa.array(start[b].astype(np.int32))], names=["doc_id", "key", "first", "last"])
        out = pa.concat_batches([out, same])
        if not carry:
            return out, None
        return out, t.take(pa.array(np.unique(row[order[~later]])))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, enough = 0, GROUP
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                held.append(part)
                size += part.column("string").nbytes
                if size < enough:
                    continue
                t = pa.Table.from_batches(held)
                h = t.column("h").to_numpy()
                open_at = int(np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))[-1])
                if open_at:
                    yield settle(t.slice(0, open_at))[0]
                    rest = t.slice(open_at)
                else:
                    out, rest = settle(t, carry=True)
                    yield out
                held = rest.combine_chunks().to_batches()
                size = sum(b.column("string").nbytes for b in held)
                enough = max(GROUP, 2 * size)
        if held:
            yield settle(pa.Table.from_batches(held))[0]

    sent = strings.select("doc_id", "key", "first", "h", "string").repartition("h").sortWithinPartitions("h", "doc_id", "key", "first")
    return sent.mapInArrow(task, "doc_id long, key long, first int, last int")


def later_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, key, runs): where windows start that also start earlier."""
    repeated = docs.sparkSession.sparkContext.broadcast(build_filter(cut(_repeated_minimizers(docs, window, gram))))
    found = cut(_strings(docs, repeated, window, gram))
    settled = found.where("h is null").select("doc_id", "key", "first", "last")
    met = _repeats(found.where("h is not null"), window)
    return merged_runs(settled.unionByName(met))


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs) and kept_bytes.

    A byte goes if a string of ``window`` bytes that covers it also starts
    earlier: in a document with a smaller doc_id or further left in its own.
    Strings are judged on the input and may overlap; they never cross
    documents.  Null text is empty.  doc_id is an integer; null ids come
    last.  Rows that repeat both doc_id and text count as one document and
    get the same result; different texts under one doc_id are ordered by a
    hash of the text.  An empty table gives an empty result.
    """
    gram = gram or min(GRAM, max(1, window // 3))
    keyed = key_of(docs.withColumn("doc_id", F.col("`doc_id`").cast("long")))
    marked = with_copies(keyed, copies(keyed))
    # of equal texts the first takes part; a later one repeats all of it
    whole = F.col("rows").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("least"))
    removal = cut(later_windows(marked.where(~whole).select("doc_id", "key", "text"), window, gram))
    found = removal.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "runs")
    joined = marked.join(small_or_shuffled(found, 120), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches):
            n_bytes = np.diff(offsets)
            removed, n_spans, kept = [], [], []
            for d, (lost, run) in enumerate(zip(rows.column(2).to_pylist(), rows.column(3).to_pylist())):
                text, n = data[offsets[d]:offsets[d + 1]], int(n_bytes[d])
                if lost and n >= window:
                    gone = np.ones(n, bool)
                elif run and not lost:
                    r = run_pairs(run).astype(np.int64)
                    gone = covered(n, r[:, 0], r[:, 1] + window)
                else:
                    gone = np.zeros(n, bool)
                removed.append(int(gone.sum()))
                n_spans.append(len(runs(np.flatnonzero(gone))[0]))
                kept.append(text[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n_bytes), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                                              pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes"])

    return joined.select("doc_id", "text", whole.alias("lost"), "runs").mapInArrow(
        task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary")
