"""Byte-pair encoding and decoding with a segment tree over pair ranks.

A text is split by the tokenizer's pattern into pieces.  The leaves of a
piece's tree are its adjacent pairs, a leaf holds (rank, position) of the
merge its pair has, and a node the smaller of its two children.  So the root
is the leftmost pair of lowest rank.  Merging it changes three leaves and
the paths above them, and the piece is done when the root holds no merge.

Pieces of up to ``SHORT`` bytes are worked on together, one row of a matrix
a tree; longer ones have a tree each.  A task keeps nothing between chunks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.llm.bytesops import CHUNK, SPACE, chunks
from estatelens.llm.packing import _ALNUM, _MARK, _ODD_SPACE, public_tokenizer_path
from estatelens.llm.shared import replace_columns

# Fixed value: the pattern of the ByteLevel pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longest piece, in bytes, whose tree is a row of a matrix.
SHORT = 128
#: Leaves of all trees of one matrix.
LEAVES = 1 << 20

_SPLIT = regex.compile(PATTERN)
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Byte ids, ranked merges and the bytes of every id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE tokenizer")
        self.library = Tokenizer.from_file(path).pre_tokenizer
        chars = byte_characters()
        byte_of = {c: b for b, c in enumerate(chars)}
        ids: dict[str, int] = model["vocab"]
        self.byte_id = np.array([ids[c] for c in chars], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)  # by rank
        self.size = max([*ids.values(), *self.special.values()]) + 1
        key = left * self.size + right
        self._rank = np.argsort(key, kind="stable")
        self._key = key[self._rank]
        self.rank_of = dict(zip(key.tolist(), range(len(key))))
        piece = [b""] * self.size
        for token, i in ids.items():
            piece[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            piece[i] = token.encode()
        self.length = np.array([len(p) for p in piece], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(piece), np.uint8)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, -1 without one or with an id of -1."""
        key = np.where((left < 0) | (right < 0), np.int64(-1), left * self.size + right)
        at = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
        return np.where(self._key[at] == key, self._rank[at], -1) if len(self._key) else np.full(len(key), -1)


@cache
def vocabulary(path: str) -> Vocabulary:
    """Read once a Python worker; its size is the vocabulary's."""
    return Vocabulary(path)


def _merge_rows(v: Vocabulary, sym: np.ndarray) -> np.ndarray:
    """Merge the rows of ``sym`` (ids, -1 after the end) until none can be.
    Returns the ids left, -1 at places that were merged away."""
    n, width = sym.shape
    leaves = width - 1
    levels = leaves.bit_length() - 1  # leaves is a power of two
    kind = np.int64 if len(v.merged) * leaves >= 1 << 31 else np.int32
    none = np.iinfo(kind).max
    r = v.ranks(sym[:, :-1].ravel(), sym[:, 1:].ravel()).astype(kind).reshape(n, leaves)
    tree = np.full((n, 2 * leaves), none, kind)
    tree[:, leaves:] = np.where(r >= 0, r * kind(leaves) + np.arange(leaves, dtype=kind), none)
    at = leaves
    while at > 1:
        at //= 2
        tree[:, at:2 * at] = np.minimum(tree[:, 2 * at:4 * at:2], tree[:, 2 * at + 1:4 * at:2])
    # neighbours that are left, by place, flat; place `width` is beyond the end
    after = np.tile(np.arange(1, width + 1, dtype=np.int32), (n, 1)).ravel()
    before = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1)).ravel()
    sym = np.concatenate([sym, np.full((n, 1), -1)], axis=1).ravel()
    tree = tree.ravel()
    live = np.arange(n)
    while True:
        root = tree[live * (2 * leaves) + 1]
        live, root = live[root < none], root[root < none]
        if not len(live):
            break
        here, link, top = live * (width + 1), live * width, live * (2 * leaves) + leaves
        p, rank = root % leaves, root // leaves
        q = after[link + p]
        nxt = after[link + q]
        new = v.merged[rank]
        sym[here + p] = new
        sym[here + q] = -1
        after[link + p] = nxt
        before[here + nxt] = p
        o = before[here + p]
        has = o >= 0
        r = v.ranks(np.concatenate([new, sym[here[has] + o[has]]]), np.concatenate([sym[here + nxt], new[has]]))
        inner = q < leaves
        tree[top[inner] + q[inner]] = none
        place = np.concatenate([p, o[has]])
        tree[np.concatenate([top, top[has]]) + place] = np.where(r >= 0, r * leaves + place, none)
        # the paths above the changed leaves
        base = np.concatenate([live, live[has], live[inner]]) * (2 * leaves)
        node = np.concatenate([place, q[inner]]) + leaves
        for _ in range(levels):
            node >>= 1
            below = base + 2 * node
            tree[base + node] = np.minimum(tree[below], tree[below + 1])
    return sym.reshape(n, width + 1)[:, :width]


def _merge_long(v: Vocabulary, ids: list[int]) -> list[int]:
    """The same for one long piece, its tree a list."""
    n = len(ids)
    leaves = 1 << max(0, (n - 2).bit_length())
    none = 1 << 62
    rank_of, merged, size = v.rank_of, v.merged, v.size

    def leaf(a: int, b: int, place: int) -> int:
        r = rank_of.get(a * size + b)
        return none if r is None else r * leaves + place

    tree = [none] * leaves + [leaf(ids[i], ids[i + 1], i) for i in range(n - 1)]
    tree += [none] * (2 * leaves - len(tree))
    for i in range(leaves - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i: int, value: int) -> None:
        i += leaves
        tree[i] = value
        while i > 1:
            i >>= 1
            value = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == value:
                return
            tree[i] = value

    while tree[1] < none:
        rank, p = divmod(tree[1], leaves)
        q = after[p]
        nxt = after[q]
        ids[p], ids[q] = int(merged[rank]), -1
        after[p] = nxt
        if q < n - 1:
            put(q, none)
        if nxt < n:
            before[nxt] = p
            put(p, leaf(ids[p], ids[nxt], p))
        else:
            put(p, none)
        if before[p] >= 0:
            put(before[p], leaf(ids[before[p]], ids[p], before[p]))
    return [i for i in ids if i >= 0]


def merge_pieces(v: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces (bytes and offsets), one after the other, and counts."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    base = v.byte_id[data]
    single = np.flatnonzero(size == 1)
    found = [(single, base[offsets[single]], np.ones(len(single), np.int64))]
    leaves = 1
    while leaves <= SHORT:
        group = np.flatnonzero((size > leaves // 2 + 1) & (size <= leaves + 1))
        for at in range(0, len(group), LEAVES // leaves):
            rows = group[at:at + LEAVES // leaves]
            place = np.arange(leaves + 1)
            sym = base[np.minimum(offsets[rows][:, None] + place, len(base) - 1)]
            left = _merge_rows(v, np.where(place < size[rows][:, None], sym, -1))
            keep = left >= 0
            found.append((rows, left[keep], keep.sum(axis=1)))
        leaves *= 2
    for i in np.flatnonzero(size > leaves // 2 + 1):
        ids = _merge_long(v, base[offsets[i]:offsets[i + 1]].tolist())
        found.append((np.array([i]), np.array(ids, np.int64), np.array([len(ids)])))
    order, flat, counts = (np.concatenate(x) for x in zip(*found))
    begin, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    begin[order] = np.cumsum(counts) - counts
    total[order] = counts
    return gather(flat, begin, total), total


def gather(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs ``flat[begin:begin + count]`` one after the other."""
    upto = np.cumsum(count)
    return flat[np.repeat(begin - (upto - count), count) + np.arange(int(upto[-1]) if len(upto) else 0)]


def _plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each unit: whether it is one piece, ASCII and Latin-1 letters
    after a space at most; and whether it holds a character from U+0500 on,
    where Unicode versions may differ."""
    latin = np.zeros(len(data), bool)
    latin[:-1] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter = _LETTER[data] | latin
    letter[1:] |= latin[:-1]
    lead = offsets[:-1]
    letter[lead[(np.diff(offsets) > 1) & (data[lead] == 0x20)]] = True
    return np.logical_and.reduceat(letter, lead), np.logical_or.reduceat(data >= 0xD4, lead)


def _pieces(v: Vocabulary, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The pieces of non-empty units: their number in each, and all of them."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    plain, high = _plain(data, offsets - offsets[0])
    split: list[list[bytes]] = []
    for unit, far in zip(words.filter(pa.array(~plain)).to_pylist(), high[~plain]):
        text = unit.decode()
        found = [text[a:b] for _, (a, b) in v.library.pre_tokenize_str(text)] if far else _SPLIT.findall(text)
        split.append([p.encode() for p in found])
    count = np.ones(len(words), np.int64)
    count[~plain] = np.fromiter(map(len, split), np.int64, len(split))
    rest = pa.array([p for s in split for p in s], pa.binary())
    # plain units in their places, the pieces of the others in theirs
    first = np.cumsum(count) - count
    take = np.empty(int(count.sum()), np.int64)
    take[first[plain]] = np.flatnonzero(plain)
    other = np.ones(len(take), bool)
    other[first[plain]] = False
    take[other] = len(words) + np.arange(len(rest))
    return count, pa.concat_arrays([words, rest]).take(pa.array(take))


def _distinct(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    d = values.dictionary_encode()
    return d.indices.to_numpy().astype(np.int64), d.dictionary


def _buffers(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(values) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, values), np.int64, len(values)), out=offsets[1:])
    return np.frombuffer(b"".join(values), np.uint8), offsets


def encode_chunk(v: Vocabulary, texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and each text's count.

    Texts are cut into units at places where the pattern always splits:
    before white space after something else, and between an ASCII letter or
    digit and an ASCII mark.  Texts with other white space are one unit;
    special tokens are cut out.  Equal units, and equal pieces of different
    units, are worked on once a chunk."""
    odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
    for s in v.special:
        odd = odd | pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
    white = SPACE[data]
    new = np.zeros(len(data) + 1, bool)
    new[1:-1] = (white[1:] & ~white[:-1]) | (_MARK[data[1:]] & _ALNUM[data[:-1]])
    doc_of = np.repeat(np.arange(len(texts)), np.diff(offsets))
    new[:-1] &= ~odd[doc_of]
    new[offsets[:-1]] = True  # also where a text is empty: the next text's start
    new[-1] = False
    fixed: dict[int, int] = {}  # place of a special token -> its id
    for i in np.flatnonzero(odd):
        raw = data[offsets[i]:offsets[i + 1]].tobytes()
        for token, ident in v.special.items():
            at = raw.find(token.encode())
            while at >= 0:
                a, b = int(offsets[i]) + at, int(offsets[i]) + at + len(token.encode())
                new[a] = True
                new[b] = new[b] or b < len(data)
                fixed[a] = ident
                at = raw.find(token.encode(), at + len(token.encode()))
    begin = np.flatnonzero(new)
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    units = pa.Array.from_buffers(pa.binary(), len(begin), [
        None, pa.py_buffer(np.append(begin, len(data)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    which, words = _distinct(units)
    n_pieces, split = _pieces(v, words)
    piece_of, pieces = _distinct(split)
    ids, n_ids = merge_pieces(v, *_buffers(pieces.to_pylist()))
    first = np.cumsum(n_ids) - n_ids
    # ids of a distinct unit: those of its pieces
    unit_ids = gather(ids, first[piece_of], n_ids[piece_of])
    unit_n = np.add.reduceat(n_ids[piece_of], np.cumsum(n_pieces) - n_pieces)
    unit_first = np.cumsum(unit_n) - unit_n
    count, start = unit_n[which], unit_first[which]
    if fixed:
        unit_ids = np.concatenate([unit_ids, np.array(list(fixed.values()), np.int64)])
        spots = np.searchsorted(begin, np.array(list(fixed), np.int64))
        count[spots] = 1
        start[spots] = len(unit_ids) - len(fixed) + np.arange(len(fixed))
    out = gather(unit_ids, start, count)
    upto = np.concatenate([[0], np.cumsum(count)])
    return out, np.diff(upto[np.searchsorted(begin, offsets)])


def decode_chunk(v: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of runs of ids; bytes that are not UTF-8 become U+FFFD, ids
    outside the vocabulary are left out."""
    known = (ids >= 0) & (ids < v.size)
    safe = np.where(known, ids, 0)
    size = np.where(known, v.length[safe], 0)
    raw = gather(v.bytes, v.first[safe], size).tobytes()
    upto = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(upto, upto[1:])]


def _ids_array(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), ids.astype(np.int32))


def encode(docs: DataFrame, tokenizer_path: str | None = None, text_col: str = "text", ids_col: str = "input_ids",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col``: the ids of each whole text, as the
    tokenizers library gives them without special tokens added.

    With ``decoded_col`` the ids are decoded in the same pass.  Null text is
    empty and has no ids.  A special token's string in a text is that token.
    Rows pass through as often as they occur, input columns named like an
    added one are replaced, an empty table gives an empty result.  A task
    holds one chunk (or one longer text) at a time."""
    added = [ids_col] + ([decoded_col] if decoded_col else [])
    text = "__text"
    rows = docs.withColumn(text, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = replace_columns(rows, *added)
    names = [c for c in rows.columns if c != text]
    rows = rows.select(*[F.col(f"`{c}`") for c in names], F.col(text))
    schema = T.StructType([*rows.drop(text).schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    if decoded_col:
        schema = schema.add(decoded_col, T.StringType())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer_path or public_tokenizer_path())
        for batch in batches:
            plain = pa.RecordBatch.from_arrays(batch.columns, names=[*[f"c{i}" for i in range(len(names))], text])
            for part, data, offsets in chunks(iter([plain]), text=text, limit=8 * CHUNK):
                ids, counts = encode_chunk(v, part.column(len(names)).cast(pa.large_string()), data, offsets)
                cols = [*part.columns[:-1], _ids_array(ids, counts)]
                if decoded_col:
                    cols.append(pa.array(decode_chunk(v, ids, counts), pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.fieldNames())

    return rows.mapInArrow(task, schema)


def decode(rows: DataFrame, tokenizer_path: str | None = None, ids_col: str = "input_ids", decoded_col: str = "decoded") -> DataFrame:
    """``rows`` with ``decoded_col``: the text of each row's ids, special
    tokens included.  Null ids are none, and null or unknown ids are left
    out; an input column named like the added one is replaced."""
    rows = replace_columns(rows, decoded_col)
    at = rows.columns.index(ids_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(decoded_col, T.StringType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer_path or public_tokenizer_path())
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                lists = part.column(at)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
                flat = pc.fill_null(pc.list_flatten(lists), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decode_chunk(v, flat, counts), pa.string())],
                                                 names=schema.fieldNames())

    return rows.mapInArrow(task, schema)
