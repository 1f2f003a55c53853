"""Benchmark decontamination: prefix-filtered set join.

An item is cut into windows of 13 words.  A document contains a window only
if it contains each of its words, so for exact containment the necessary
prefix of a window, its tokens ordered by rarity, is the single rarest one.
Rarity is counted over all documents.  A document word that is the rarest
token of a window fixes where the window would have to lie (positional
bound); that place must be inside the document (length bound), and only
then are the words compared, first by their hash, then byte by byte.

The benchmark is a stated query set.  It is cut into blocks of bounded size
and every block is searched in all documents, so no task and no broadcast
grows with the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.bytesops import ITEM_WORD, LOWER, Rolling, chunks, covered, runs, spans, word_hashes
from estatelens.llm.shared import columns_of, cut, small_or_shuffled

WINDOW = 13
#: Text bytes of a benchmark block.
BLOCK_BYTES = 8 << 20
_RESULT = "doc_id {kind}, text_key long, n_words long, hits array<struct<first:long,last:long>>, items array<string>"


class Windows:
    """The windows of one block of items, as arrays that pickle small."""

    def __init__(self, item_ids: list[str], texts: list[str | None]):
        raw = [(t or "").encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        self.data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
        starts, ends, first = spans(self.data, offsets, ITEM_WORD)
        self.starts, self.ends = starts, ends
        words = word_hashes(self.data, starts, ends)
        self.vocabulary, token = np.unique(words, return_inverse=True)
        n = np.diff(first)
        self.item_ids = item_ids
        at, length, item = [], [], []
        for i, (a, k) in enumerate(zip(first[:-1].tolist(), n.tolist())):
            if k:
                w = min(WINDOW, k)
                s = np.arange(a, a + k - w + 1)
                at.append(s)
                length.append(np.full(len(s), w))
                item.append(np.full(len(s), i))
        empty = np.zeros(0, np.int64)
        self.at = np.concatenate([empty, *at])
        self.length = np.concatenate([empty, *length])
        self.item = np.concatenate([empty, *item])
        self.hash = Rolling(words, 1)(self.at, self.at + self.length) if len(self.at) else np.zeros(0, np.uint64)
        self.token = token

    def order_by_rarity(self, frequency: np.ndarray) -> None:
        """Post each window under its rarest word; of equal windows (same
        words) the postings stay apart, one for each item."""
        rank = np.empty(len(frequency), np.int64)
        rank[np.lexsort((self.vocabulary, frequency))] = np.arange(len(frequency))
        r = rank[self.token]
        pos = np.empty(len(self.at), np.int64)
        for w in np.unique(self.length):  # the prefix: first token by rarity
            sel = np.flatnonzero(self.length == w)
            pos[sel] = np.argmin(r[self.at[sel][:, None] + np.arange(w)], axis=1)
        key = self.token[self.at + pos] if len(pos) else pos
        order = np.argsort(key, kind="stable")
        self.offset_in_window = pos[order]
        self.window = order
        self.post = np.searchsorted(key[order], np.arange(len(self.vocabulary) + 1))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary index of document words, -1 for others."""
        if not len(self.vocabulary) or not len(hashes):
            return np.full(len(hashes), -1)
        i = np.searchsorted(self.vocabulary, hashes)
        i[i == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[i] == hashes, i, -1)


def _same_words(a: np.ndarray, s: np.ndarray, e: np.ndarray, b: np.ndarray, t: np.ndarray, u: np.ndarray) -> bool:
    """Word sequences compared byte by byte."""
    return len(s) == len(t) and all(a[i:j].tobytes() == b[k:m].tobytes() for i, j, k, m in zip(s, e, t, u))


def _frequencies(docs: DataFrame, vocabulary) -> np.ndarray:
    """How often each word of the vocabulary occurs in all documents."""
    n = len(vocabulary.value)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary.value
        count = np.zeros(n + 1, np.int64)
        for _, data, offsets in chunks(batches):
            low = LOWER[data]
            starts, ends, _ = spans(low, offsets, ITEM_WORD)
            h = word_hashes(low, starts, ends)
            if n and len(h):
                i = np.searchsorted(voc, h)
                i[i == n] = 0
                count += np.bincount(np.where(voc[i] == h, i, n), minlength=n + 1)
        seen = np.flatnonzero(count[:n])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(count[seen])], names=["token", "n"])

    out = np.zeros(n, np.int64)
    for r in docs.select("text").mapInArrow(task, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["token"]] = r["n"]
    return out


def _search(docs: DataFrame, block) -> DataFrame:
    """Per document: its words, hit word ranges, and items found."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Windows = block.value
        for rows, data, offsets in chunks(batches):
            low = LOWER[data]
            starts, ends, first = spans(low, offsets, ITEM_WORD)
            h = word_hashes(low, starts, ends)
            voc = b.find(h)
            roll = Rolling(h, 1)
            at = np.flatnonzero(voc >= 0)
            n_post = b.post[voc[at] + 1] - b.post[voc[at]]
            hits: dict[int, tuple[list, list, set]] = {}
            done = 0
            while done < len(at):  # bounded numbers of candidate places at a time
                k = max(1, int(np.searchsorted(np.cumsum(n_post[done:]), 1 << 20, "right")))
                word = np.repeat(at[done:done + k], n_post[done:done + k])
                m = n_post[done:done + k]
                entry = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m) + np.repeat(b.post[voc[at[done:done + k]]], m)
                done += k
                window = b.window[entry]
                begin = word - b.offset_in_window[entry]
                end = begin + b.length[window]
                doc = np.searchsorted(first, word, "right") - 1
                fits = (begin >= first[doc]) & (end <= first[doc + 1])  # positional and length bounds
                begin, end, window, doc = begin[fits], end[fits], window[fits], doc[fits]
                same = roll(begin, end) == b.hash[window]
                for s, e, w, d in zip(begin[same].tolist(), end[same].tolist(), window[same].tolist(), doc[same].tolist()):
                    t = int(b.at[w])
                    if _same_words(low, starts[s:e], ends[s:e], b.data, b.starts[t:t + e - s], b.ends[t:t + e - s]):
                        got = hits.setdefault(d, ([], [], set()))
                        got[0].append(s)
                        got[1].append(e)
                        got[2].add(b.item_ids[int(b.item[w])])
            n = np.diff(first)
            hit_runs, items = [], []
            for d in range(rows.num_rows):
                if d in hits:
                    s, e, found = hits[d]
                    f, last = runs(np.flatnonzero(covered(int(n[d]), np.array(s) - first[d], np.array(e) - first[d])))
                    hit_runs.append([{"first": int(x), "last": int(y)} for x, y in zip(f, last)])
                    items.append(sorted(found))
                else:
                    hit_runs.append([])
                    items.append([])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(n, pa.int64()),
                 pa.array(hit_runs, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                 pa.array(items, pa.list_(pa.string()))], names=["doc_id", "text_key", "n_words", "hits", "items"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text_key", "text").mapInArrow(task, _RESULT.format(kind=kind))


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list[str], list[str]]]:
    ids, texts, size = [], [], 0
    items = columns_of(benchmark, "item_id", "text").where("text is not null").select(F.col("item_id").cast("string"), "text")
    for r in items.toLocalIterator():
        if ids and size + len(r[1]) > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r[0] if r[0] is not None else "")
        texts.append(r[1])
        size += len(r[1])
    yield ids, texts


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, ``hits`` (ranges of
    words, first and last, that lie in an occurrence of a window) and
    ``items`` (sorted ids, as strings, of items with such windows).

    Words are runs of digits, letters a-z (A-Z lowered) and non-ASCII
    characters.  Null text has no words; an item without words has no
    window; an item with a null id has the id ''.  Items that repeat are
    reported once by id.  Repeated documents are each reported.  An empty
    benchmark leaves every document clean.
    """
    spark = docs.sparkSession
    text = F.col("`text`")
    narrow = docs.select(F.col("`doc_id`").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    parts = []
    for ids, texts in _blocks(benchmark, block_bytes):
        block = Windows(ids, texts)
        block.order_by_rarity(_frequencies(narrow, spark.sparkContext.broadcast(block.vocabulary)))
        parts.append(_search(narrow, spark.sparkContext.broadcast(block)))
    if len(parts) == 1:
        return parts[0]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    merged = both.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("all_hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.count(F.lit(1)) / F.lit(len(parts))).cast("int").alias("copies"))
    words = F.array_sort(F.array_distinct(F.flatten(F.transform("all_hits", lambda h: F.sequence(h["first"], h["last"])))))
    again = F.transform(words, lambda w: F.struct(w.alias("first"), w.alias("last")))
    return (merged.withColumn("hits", again).withColumn("i", F.explode(F.sequence(F.lit(1), "copies")))
            .select("doc_id", "text_key", "n_words", "hits", "items"))


def judged(found: DataFrame) -> DataFrame:
    """``found`` with n_hit, n_items, items_sha256 and contaminated: at
    least a twentieth of the words hit."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["last"] - h["first"] + 1)
    return found.select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept."""
    bad = cut(judged(contamination(docs, benchmark)).where("contaminated")
              .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct())
    same = F.col("`doc_id`").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("`text`")) == F.col("__key"))
    return docs.join(small_or_shuffled(bad, 64), same, "left_anti")
