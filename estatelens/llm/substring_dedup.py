"""Substring deduplication with fixed-block anchors, on words.

Every document is cut into non-overlapping reference blocks of half a
window.  A window holds at least one whole reference block of its own
document, and if the window repeats, that block also occurs at the other
place, there at any offset.  So: index the reference blocks, probe them with
every rolling window of block length, keep the blocks that occur twice, and
extend them by the words on both sides: to every window around them.  Such
windows are compared by their words: within a chunk word by word, a run of
windows being extended by its next word, between chunks by a 128-bit BLAKE2
digest of the words.  Equal ones merge into maximal exact repeats.  Rolling
hashes only preselect.

The index reaches the probing tasks as a Bloom filter of bounded size; what
passes is grouped exactly.  A denser filter lets more rows shuffle and
changes no result.  Inside a chunk of documents equal windows are settled at
once, so a passage that a third of the documents share arrives in the
shuffle as one row a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.bytesops import SPACE, Filter, Rolling, chunks, runs, spans, word_hashes
from estatelens.llm.shared import cut, small_or_shuffled

WINDOW = 35
BITS_PER_ENTRY = 16
#: The largest filter: 2**29 bits are 64 MB.
MAX_FILTER_BITS = 1 << 29
_NONE = np.zeros(0, np.int64)


def build_filter(hashes: DataFrame, max_bits: int = MAX_FILTER_BITS) -> Filter:
    """A filter of column ``h`` (longs), gathered as a fixed number of bits.

    Its words are OR-ed in Spark, so what reaches the driver is bounded by
    ``max_bits`` whatever the number of rows."""
    n = hashes.count()
    bits = 1 << 16
    while bits < min(BITS_PER_ENTRY * n, max_bits):
        bits *= 2
    words = 512

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = Filter.slots(batch.column(0).to_numpy().view(np.uint64), bits)
            slot = np.unique(np.concatenate(slots)) if batch.num_rows else np.zeros(0, np.uint64)
            word = slot >> np.uint64(6)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(slot) else _NONE
            value = np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), first) if len(first) else slot
            yield pa.RecordBatch.from_arrays([pa.array(word[first].view(np.int64)), pa.array(value.view(np.int64))], names=["word", "value"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([np.array(x.as_py(), np.uint16).tobytes() for x in batch.column(1)], pa.binary()),
                 pa.array([np.array(x.as_py(), np.int64).tobytes() for x in batch.column(2)], pa.binary())], names=["part", "at", "value"])

    merged = hashes.select("h").mapInArrow(task, "word long, value long").groupBy("word").agg(F.expr("bit_or(value)").alias("value"))
    part = F.floor(F.col("word") / words)
    parts = (merged.groupBy(part.alias("part"))
             .agg(F.collect_list(F.struct(F.pmod("word", F.lit(words)).alias("at"), "value")).alias("x"))
             .select("part", F.col("x.at").alias("at"), F.col("x.value").alias("value")))
    out = Filter(bits)
    for r in parts.mapInArrow(pack, "part long, at binary, value binary").collect():  # bounded by max_bits
        out.words[r["part"] * words + np.frombuffer(r["at"], np.uint16).astype(np.int64)] = np.frombuffer(r["value"], np.int64).view(np.uint64)
    return out


def key_of(docs: DataFrame) -> DataFrame:
    """doc_id, text, and ``key``: a hash of the text.  Rows are told apart by
    doc_id and key, so different texts under one id stay apart."""
    return docs.select(F.col("`doc_id`").alias("doc_id"), F.coalesce(F.col("`text`"), F.lit("")).alias("text"),
                       F.xxhash64("`text`").alias("key"))


def copies(docs: DataFrame) -> DataFrame:
    """Texts that occur more than once: sha, the least doc_id, rows."""
    sha = F.unhex(F.sha2("text", 256))
    return cut(docs.groupBy(sha.alias("sha")).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")).where("rows > 1"))


def with_copies(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` with ``least`` and ``rows`` of their copies, null if alone."""
    return (docs.withColumn("__sha", F.unhex(F.sha2("text", 256)))
            .join(small_or_shuffled(repeated, 120), F.col("__sha") == F.col("sha"), "left").drop("__sha", "sha"))


class Words:
    """Words of a chunk and hashes of their windows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends, self.first = spans(data, offsets, ~SPACE)
        h = word_hashes(data, self.starts, self.ends)
        self.n = np.diff(self.first)
        self.roll = Rolling(h, 1)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self.left = np.repeat(self.first[1:], self.n) - np.arange(len(h))  # words from here to the document's end
        self.place = np.arange(len(h)) - np.repeat(self.first[:-1], self.n)
        self._data = data

    @cached_property
    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with one space after each, and where each begins."""
        size = self.ends - self.starts + 1
        upto = np.concatenate([[0], np.cumsum(size)])
        flat = np.append(self._data, np.uint8(0x20))[np.minimum(
            np.repeat(self.starts - upto[:-1], size) + np.arange(int(upto[-1])), len(self._data))]
        flat[upto[1:] - 1] = 0x20
        return flat, upto

    @cached_property
    def codes(self) -> np.ndarray:
        """A number for each word, equal for equal words of the chunk only."""
        flat, upto = self.joined
        words = pa.Array.from_buffers(pa.binary(), len(upto) - 1, [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(flat)])
        return words.dictionary_encode().indices.to_numpy()

    def same(self, at: np.ndarray, other: np.ndarray, window: int) -> bool:
        """Whether the windows at ``at`` (ascending) and ``other`` have the
        same words.  Where both go on from the window before, only the word
        that is new is compared."""
        on = np.zeros(len(at), bool)
        on[1:] = (np.diff(at) == 1) & (np.diff(other) == 1)
        size = np.where(on, 1, window)
        back = np.where(on, window - 1, 0)
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(back, size)
        return bool((self.codes[np.repeat(at, size) + within] == self.codes[np.repeat(other, size) + within]).all())

    def digests(self, at: np.ndarray, window: int) -> np.ndarray:
        """128 bits of BLAKE2 of each window's words: two numbers a row."""
        flat, upto = self.joined
        raw = flat.tobytes()
        made = b"".join([blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(upto[at].tolist(), upto[at + window].tolist())])
        return np.frombuffer(made, np.uint64).reshape(-1, 2)

    def starts_of(self, window: int, at_least: int) -> np.ndarray:
        """Starts of ``window`` words in documents of ``at_least`` words."""
        long_enough = np.repeat(self.n >= at_least, self.n)
        return np.flatnonzero((self.left >= window) & long_enough)

    def hash(self, at: np.ndarray, window: int) -> np.ndarray:
        return self.roll(at, at + window)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _blocks(docs: DataFrame, window: int) -> DataFrame:
    """Hashes of the reference blocks, once a chunk."""
    block = (window + 1) // 2

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in chunks(batches):
            w = Words(data, offsets)
            at = w.starts_of(block, window)
            yield pa.RecordBatch.from_arrays([_signed(np.unique(w.hash(at[w.place[at] % block == 0], block)))], names=["h"])

    return docs.select("text").mapInArrow(task, "h long")


def _repeated_blocks(docs: DataFrame, index, window: int) -> DataFrame:
    """Reference blocks that occur at two places or more (column h)."""
    block = (window + 1) // 2

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: Filter = index.value
        for _, data, offsets in chunks(batches):
            w = Words(data, offsets)
            at = w.starts_of(block, window)
            h = w.hash(at, block)
            hit = f.has(h)
            aligned = (w.place[at] % block == 0)[hit]
            u, back, n = np.unique(h[hit], return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [_signed(u), pa.array(n), pa.array(np.bincount(back, aligned, len(u)).astype(np.int64))], names=["h", "n", "aligned"])

    return (docs.select("text").mapInArrow(task, "h long, n long, aligned long").groupBy("h")
            .agg(F.sum("n").alias("n"), F.sum("aligned").alias("aligned")).where("n > 1 and aligned > 0").select("h"))




def _candidates(docs: DataFrame, repeated, window: int) -> DataFrame:
    """Windows around repeated blocks.  Those equal to another of the same
    chunk are settled: rows (doc_id, key, first, last) without hash.  One
    of each goes on, with its digest, to be compared with other chunks."""
    block = (window + 1) // 2

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: Filter = repeated.value
        for rows, data, offsets in chunks(batches):
            w = Words(data, offsets)
            at = w.starts_of(window, window)
            if not len(at):
                continue
            own = np.zeros(len(w.doc), bool)
            b = w.starts_of(block, window)
            b = b[w.place[b] % block == 0]
            own[b] = f.has(w.hash(b, block))
            at = at[own[at + (-w.place[at]) % block]]  # the first reference block inside the window
            if not len(at):
                continue
            _, one, back, n = np.unique(w.hash(at, window), return_index=True, return_inverse=True, return_counts=True)
            many = np.flatnonzero(n[back] > 1)
            if not w.same(at[many], at[one[back[many]]], window):  # a hash that two texts share
                _, one, back, n = np.unique(w.digests(at, window), axis=0, return_index=True, return_inverse=True, return_counts=True)
                back = back.ravel()
            settled = n[back] > 1
            s, e = runs(at[settled])
            witness = one[n > 1]
            go = np.concatenate([np.flatnonzero(~settled), witness])
            told = np.concatenate([np.zeros(int((~settled).sum()), bool), np.ones(len(witness), bool)])
            docs_of = np.concatenate([w.doc[s], w.doc[at[go]]])
            first = np.concatenate([w.place[s], w.place[at[go]]])
            last = np.concatenate([w.place[e], w.place[at[go]]])
            blank = np.concatenate([np.ones(len(s), bool), np.zeros(len(go), bool)])
            take = pa.array(docs_of)
            digest = w.digests(at[go], window)
            hh = np.concatenate([np.zeros(len(s), np.uint64), digest[:, 0]]).view(np.int64)
            gg = np.concatenate([np.zeros(len(s), np.uint64), digest[:, 1]]).view(np.int64)
            twice = np.concatenate([np.zeros(len(s), np.int64), np.where(told, 2, 1)])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(take), rows.column(1).take(take), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                 pa.array(hh, mask=blank), pa.array(gg, mask=blank), pa.array(twice.astype(np.int32))],
                names=["doc_id", "key", "first", "last", "h", "g", "twice"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "key", "text").mapInArrow(
        task, f"doc_id {kind}, key long, first int, last int, h long, g long, twice int")


def _matched(open_rows: DataFrame) -> DataFrame:
    """Of windows that met no equal in their chunk, those that meet one in
    another.  Each partition is sorted by hash and streamed: equal hashes
    are neighbours, so memory does not depend on how many there are."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch if held is None else pa.concat_batches([held, batch])
            h, g = t.column("h").to_numpy(), t.column("g").to_numpy()
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
            last = int(np.flatnonzero(new)[-1])
            tail = t.slice(last)
            if tail.num_rows > 2:  # enough of the open group: an earlier row and this one
                yield _pick(t, h, g, t.num_rows)
                held = tail.slice(tail.num_rows - 2)
                held = held.set_column(held.schema.get_field_index("twice"), "twice", pa.array([9, 9], pa.int32()))
            else:
                yield _pick(t, h, g, last)
                held = tail
        if held is not None:
            yield _pick(held, held.column("h").to_numpy(), held.column("g").to_numpy(), held.num_rows)

    def _pick(t, h, g, n):
        if not n:
            return t.slice(0, 0).select(["doc_id", "key", "first"])
        h, g = h[:n], g[:n]
        twice = t.column("twice").to_numpy()[:n]
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])]))
        size = np.diff(np.append(new, n))
        many = np.repeat(size > 1, size)
        keep = np.flatnonzero(many & (twice == 1))
        return t.take(pa.array(keep)).select(["doc_id", "key", "first"])

    kind = open_rows.schema["doc_id"].dataType.simpleString()
    dealt = open_rows.select("doc_id", "key", "first", "h", "g", "twice").repartition("h").sortWithinPartitions("h", "g", "twice")
    return dealt.mapInArrow(task, f"doc_id {kind}, key long, first int")



def merged_runs(parts: DataFrame) -> DataFrame:
    """(doc_id, key, runs) from (doc_id, key, first, last): each document's
    ranges merged, as 32-bit pairs of first and last."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for first, last in zip(batch.column(2), batch.column(3)):
                f, to = first.values.to_numpy(), last.values.to_numpy()
                order = np.argsort(f, kind="stable")
                f, to = f[order], np.maximum.accumulate(to[order])
                new = np.flatnonzero(np.concatenate([[True], f[1:] > to[:-1] + 1]))
                out.append(np.stack([f[new], to[np.append(new[1:], len(f)) - 1]], axis=1).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["doc_id", "key", "runs"])

    kind = parts.schema["doc_id"].dataType.simpleString()
    grouped = parts.groupBy("doc_id", "key").agg(F.collect_list(F.struct("first", "last")).alias("x"))
    return grouped.select("doc_id", "key", "x.first", "x.last").mapInArrow(task, f"doc_id {kind}, key long, runs binary")


def run_pairs(runs: bytes | None) -> np.ndarray:
    return np.frombuffer(runs or b"", np.int32).reshape(-1, 2)


def repeated_runs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, key, runs): where windows start that also start elsewhere,
    in words, for rows of :func:`key_of`; runs as :func:`merged_runs`."""
    spark = docs.sparkSession
    index = spark.sparkContext.broadcast(build_filter(cut(_blocks(docs, window))))
    again = spark.sparkContext.broadcast(build_filter(cut(_repeated_blocks(docs, index, window))))
    found = cut(_candidates(docs, again, window))
    settled = found.where("h is null").select("doc_id", "key", "first", "last")
    met = _matched(found.where("h is not null")).select("doc_id", "key", "first", F.col("first").alias("last"))
    return merged_runs(settled.unionByName(met))


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and kept_text: its
    words but for those that lie in a window of ``window`` words whose word
    sequence also starts anywhere else, joined by one space.

    Words are runs without ASCII white space, unchanged.  Null text has no
    words.  All copies of a repeated window go, the first included; windows
    are judged on the input.  A row whose text another row repeats loses all
    its words if it has ``window`` or more; rows that repeat a doc_id are
    separate rows.  An empty table gives an empty result.
    """
    if window < 2:
        raise ValueError("a window has two words or more")
    keyed = key_of(docs)
    repeated = copies(keyed)
    marked = with_copies(keyed, repeated)
    # of equal texts one takes part, all lose everything
    alone = marked.where(F.col("rows").isNull() | F.col("doc_id").eqNullSafe(F.col("least"))).select("doc_id", "key", "text")
    removal = cut(repeated_runs(alone, window))
    found = removal.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "runs")
    joined = marked.join(small_or_shuffled(found, 120), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches):
            starts, ends, first = spans(data, offsets, ~SPACE)
            texts, removed = [], []
            for d, (lost, run) in enumerate(zip(rows.column(2).to_pylist(), rows.column(3).to_pylist())):
                s, e = starts[first[d]:first[d + 1]], ends[first[d]:first[d + 1]]
                gone = np.zeros(len(s) + 1, np.int64)  # +1 where a run of windows begins, -1 where it ends
                if lost and len(s) >= window:
                    gone[0] = 1
                for f, to in run_pairs(run).tolist():
                    gone[f] += 1
                    gone[to + window] -= 1
                keep = np.cumsum(gone[:-1]) == 0
                texts.append(b" ".join([data[i:j].tobytes() for i, j in zip(s[keep].tolist(), e[keep].tolist())]))
                removed.append(len(s) - int(keep.sum()))
            n = np.diff(first)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    lost = F.col("rows").isNotNull().alias("lost")
    return joined.select("doc_id", "text", lost, "runs").mapInArrow(
        task, f"doc_id {kind}, n_words long, n_removed long, kept_text string")
