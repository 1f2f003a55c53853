"""Packing by power-of-two decomposition.

Every document (its token ids and one end id) is split into full sequences
and, for the rest, the powers of two of its length in binary.  A piece is a
sequence by itself, and sequences of equal length form a bucket, so no
sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.bytesops import CHUNK, SPACE, chunks, give_back

SEQUENCE = 1024
END_ID = 0
#: Bytes of units and ids that a task remembers: the first it meets, which
#: are mostly the frequent ones.  Others are encoded each time.
MEMORY = 32 << 20
#: Longest unit, in bytes, that is remembered.
LONGEST = 64
#: Bytes of texts that are worked on at once: equal units among them are
#: looked up once.
TEXT = 8 * CHUNK
#: Units that are encoded as one text.
RUN = 512
#: What a unit takes besides, with its place in the table of a look-up.
_ENTRY = 64

# White space beyond ASCII, and control characters that some libraries call
# white space: a text that holds one is tokenised as a whole.
_ODD_SPACE = "[\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x41:0x5B] = _ALNUM[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[0x21:0x7F] = ~_ALNUM[0x21:0x7F]


def public_tokenizer_path() -> str:
    """The default tokenizer's file on this machine (never copied)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of whole texts.

    Byte-level BPE splits a text before it merges, and a split always falls
    before white space that follows a character that is none, and between an
    ASCII letter or digit and an ASCII mark.  Units between
    such places are encoded once and looked up afterwards; equal results to
    encoding whole texts are tested.  Units not met before are encoded many
    at a time, one after the other in a text that splits between them."""

    def __init__(self, path: str):
        # a worker has one core: threads of the tokenizer would only wait for each other
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder()
        self._special = [t.content for t in added.values()]
        # bytes of each id: a byte-level token has a character for a byte
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._bytes = np.ones(max(vocabulary.values(), default=0) + 1, np.int64)
        self._bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        for i, t in added.items():
            self._bytes[i] = len(t.content.encode())
        self._known = pa.array([], pa.binary())
        self._ids = np.zeros(0, np.uint32)
        self._size = np.zeros(0, np.int64)
        self._held = 0

    def _texts(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _encode(self, units: pa.Array, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after the other, and each unit's count.

        A unit goes on the text of the one before it if a split falls between
        them and neither is to be ``alone``, unless a special token would
        come about.  Counts are where a unit's bytes end; if ids do not tell,
        each unit is a text."""
        if not len(units):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        offsets = np.frombuffer(units.buffers()[1], np.int32)[units.offset:units.offset + len(units) + 1].astype(np.int64)
        raw = units.buffers()[2].to_pybytes()
        data = np.frombuffer(raw, np.uint8)
        head, tail = data[offsets[1:-1]], data[offsets[1:-1] - 1]
        goes_on = (SPACE[head] & ~SPACE[tail]) | (_MARK[head] & _ALNUM[tail])
        goes_on &= ~(alone[1:] | alone[:-1])
        goes_on[RUN - 1::RUN] = False

        def joined() -> tuple[np.ndarray, list[str]]:
            first = np.append(np.flatnonzero(np.append(True, ~goes_on)), len(units))
            cuts = offsets[first].tolist()
            return first, [raw[a:b].decode() for a, b in zip(cuts, cuts[1:])]

        first, texts = joined()
        for k, t in enumerate(texts):
            if any(s in t for s in self._special):
                goes_on[first[k]:first[k + 1] - 1] = False
        first, texts = joined()
        ids = np.concatenate(self._texts(texts))
        upto = np.concatenate([[0], np.cumsum(self._bytes[ids])])
        ends = np.searchsorted(upto, offsets - offsets[0])
        if upto[-1] == offsets[-1] - offsets[0] and (upto[ends] == offsets - offsets[0]).all():
            return ids, np.diff(ends)
        goes_on[:] = False
        found = self._texts(joined()[1])
        return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))

    def chunk(self, texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and each text's count."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
        for s in self._special:
            odd = odd | pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        white = SPACE[data]
        new = np.zeros(len(data), bool)
        new[1:] = (white[1:] & ~white[:-1]) | (_MARK[data[1:]] & _ALNUM[data[:-1]])
        for i in np.flatnonzero(odd):
            new[offsets[i]:offsets[i + 1]] = False
        new[offsets[:-1][offsets[:-1] < len(data)]] = True
        begin = np.flatnonzero(new)
        units = pa.Array.from_buffers(pa.binary(), len(begin), [
            None, pa.py_buffer(np.append(begin, len(data)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        words, which = units.dictionary, units.indices.to_numpy()
        alone = np.zeros(len(words), bool)
        if odd.any():
            alone[which[odd[np.searchsorted(offsets, begin, "right") - 1]]] = True
        at = pc.fill_null(pc.index_in(words, value_set=self._known), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        met = words.take(pa.array(missing))
        met_ids, met_size = self._encode(met, alone[missing])
        at[missing] = len(self._size) + np.arange(len(missing))
        flat, size = np.concatenate([self._ids, met_ids]), np.concatenate([self._size, met_size])
        if self._held < MEMORY:
            length = pc.binary_length(met).to_numpy(zero_copy_only=False)
            short = length <= LONGEST
            kept = met_ids[np.repeat(short, met_size)]
            self._known = pa.concat_arrays([self._known, met.filter(pa.array(short))])
            self._ids, self._size = np.concatenate([self._ids, kept]), np.concatenate([self._size, met_size[short]])
            self._held += int(length[short].sum()) + kept.nbytes + _ENTRY * int(short.sum())
        spot = at[which]
        n = size[spot]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat((np.cumsum(size) - size)[spot] - upto[:-1], n) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.searchsorted(begin, offsets)])


def piece_lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """n as full pieces and the powers of two of the rest, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(longest.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str | None = None, longest: int = SEQUENCE, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, unless ``with_ids`` is false, input_ids.

    A document is its token ids and ``end_id``; null text is empty, so it is
    the end id alone.  ``longest`` must be a power of two.  A piece is a
    whole sequence: offset 0, length a power of two, no padding.  Sequences
    are numbered as ``monotonically_increasing_id`` numbers rows; write them
    with ``partitionBy("length")`` to have the buckets as folders.  Repeated
    documents are packed as often as they occur; an empty table gives an
    empty result.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    path = tokenizer_path

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path or public_tokenizer_path())
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        for rows, data, offsets in chunks(batches, limit=TEXT):
            texts = pc.fill_null(rows.column(1).cast(pa.large_string()), "")
            ids, n_ids = encoder.chunk(texts, data, offsets)
            first = np.cumsum(n_ids) - n_ids
            doc, start, length, crc, total, out = [], [], [], [], [], []
            for d, (a, n) in enumerate(zip(first.tolist(), n_ids.tolist())):
                whole = np.append(ids[a:a + n], np.uint32(end_id)).astype("<u4")
                at = 0
                for k in piece_lengths(n + 1, longest):
                    doc.append(d)
                    start.append(at)
                    length.append(k)
                    crc.append(zlib.crc32(whole[at:at + k].tobytes()))
                    total.append(n + 1)
                    out.append(whole[at:at + k])
                    at += k
            for lo in range(0, len(doc), 4096):
                s = slice(lo, lo + 4096)
                m = len(doc[s])
                cols = [rows.column(0).take(pa.array(doc[s], pa.int64())), *[pa.array(x[s], pa.int64()) for x in (start, length, crc, total)],
                        pa.array(np.arange(number, number + m)), pa.array(np.zeros(m, np.int64))]
                if with_ids:
                    flat = np.concatenate(out[s]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(length[s])]).astype(np.int32), flat))
                number += m
                yield pa.RecordBatch.from_arrays(cols, names=names)
        # workers outlive the stage: neither tokenizer nor what it met stays
        del encoder
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["input_ids"] * with_ids
    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:7]) + ", input_ids array<int>" * with_ids
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return narrow.mapInArrow(task, schema)
