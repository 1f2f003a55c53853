"""The prefix trie of conversations, by burst tries.

A conversation is a sequence of turn ids.  Equal sequences become one entry
with its number of conversations.  A container holds the suffixes of the
entries below a trie head.  While a container holds more than ``CONTAINER``
turns of different entries it is burst: its head becomes a trie node, and
its entries go to one container for each next turn id.  The containers that
are left are dealt to tasks, sorted and swept with a stack, which gives the
nodes below their heads; sums over subtrees go up through the heads.

An entry that is alone in a container that is still too large (one very long
conversation) is a chain, and its nodes come straight from its turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.shared import BROADCAST_BYTES, cut, small_or_shuffled
from estatelens.operators.heavy import split_join
from estatelens.operators.ordered import segmented_scan

#: Turns of a container that a task sorts.
CONTAINER = 1024
#: Conversations that share their first turns: c - c % FAMILY and those after.
FAMILY = 20
#: Most turns taken from the family's first conversation, plus one.
HEADS = 4
#: Ids (2 to this power) whose decimal digits are joined in one row.
ID_BLOCK = 13

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of the SHA-256 of a turn."""
    return F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, id, words, upto) of every turn, places from 1 in the
    order of turn, null first; ties by role and text.  Null role and text
    are empty; rows without a conv_id belong to no conversation."""
    text = F.coalesce(F.col("`text`"), F.lit(""))
    role = F.coalesce(F.col("`role`"), F.lit(""))
    rows = conversations.where(F.col("`conv_id`").isNotNull()).select(
        F.col("`conv_id`").cast("long").alias("conv_id"), F.col("`turn`").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.select("*", turn_id(F.col("role"), F.col("text")).alias("id"),
                       F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"))
    found = segmented_scan(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "text"], number="place", running={"upto": "words"})
    return cut(found.select("conv_id", "place", "id", "words", "upto"))


def rebuilt(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, len) and their rebuilt turns (conv_id, pos,
    id, words, rest): ``pos`` from 0, ``rest`` the words from there on."""
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    own = ranked.groupBy("conv_id").agg(F.max("place").alias("n"), F.max("upto").alias("total"),
                                        F.max(F.when(F.col("place") <= taken, F.col("upto"))).alias("skipped"))
    own = own.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), taken.alias("h"), "n", "total",
                     (F.col("total") - F.coalesce("skipped", F.lit(0))).alias("own_words"))
    sizes = own.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    convs = own.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = cut(convs.select("conv_id", "base", "h", "total", "own_words", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")))
    behind = split_join(ranked.where(F.col("place") > taken), convs.select("conv_id", "h", "taken", "total"), ["conv_id"])
    behind = behind.select("conv_id", (F.col("taken") + F.col("place") - F.col("h") - 1).alias("pos"), "id", "words",
                           (F.col("total") - F.col("upto") + F.col("words")).alias("rest"))
    heads = ranked.where((F.col("place") < HEADS) & (F.col("conv_id") % FAMILY == 0)).select(F.col("conv_id").alias("base"), "place", "id", "words", "upto")
    ahead = convs.where("taken > 0").join(heads, "base").where("place <= taken")
    last = ahead.groupBy("conv_id").agg(F.max("upto").alias("head_words"))
    ahead = ahead.join(last, "conv_id").select(
        "conv_id", (F.col("place") - 1).alias("pos"), "id", "words", (F.col("head_words") - F.col("upto") + F.col("words") + F.col("own_words")).alias("rest"))
    return convs.select("conv_id", "len"), cut(behind.unionByName(ahead))


def _entries(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(rep, n, len, ends): one row for each different sequence, with its
    least conversation, their number and the hash of their ids.

    Sequences are equal if their lengths and the 256-bit sums of the SHA-256
    of their (place, id) pairs are."""
    digest = F.sha2(F.concat(F.col("pos").cast("string").cast("binary"), F.col("id")), 256)
    parts = [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = turns.groupBy("conv_id").agg(*[F.sum(p).alias(f"s{i}") for i, p in enumerate(parts)])
    key = F.unhex(F.substring(F.sha2(F.concat_ws("|", "len", "s0", "s1", "s2", "s3"), 256), 1, 32))
    members = cut(convs.join(sums, "conv_id", "left").select("conv_id", "len", key.alias("seq")))
    # ids of copies: joined in blocks of bounded size, then hashed block by block
    blocks = members.groupBy("seq", F.shiftright("conv_id", ID_BLOCK).alias("block")).agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("len").alias("len"),
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, row, sha = None, None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["seq"] != seq:
                    if row:
                        out.append({**row, "ends": sha.hexdigest()})
                    seq, row, sha = r["seq"], r, hashlib.sha256(r["ids"].encode())
                else:
                    sha.update(b"," + r["ids"].encode())
                    row["n"] += r["n"]
                    row["rep"] = min(row["rep"], r["rep"])
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if row:
            yield pa.RecordBatch.from_pylist([{**row, "ends": sha.hexdigest()}], schema=schema)

    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("len", pa.int64()), ("ends", pa.string())])
    ordered = blocks.repartition("seq").sortWithinPartitions("seq", "block")
    return cut(ordered.mapInArrow(task, "rep long, n long, len long, ends string"))


def sweep(entries: list[tuple[list[bytes], list[int], int, int, str]], depth: int, parent: int | None) -> list[list]:
    """Nodes of a container: rows of ``NODE``, the container's top first.

    An entry is (ids from its head's turn on, their words, conversation,
    copies, hash of the ends); all share the first id, which is at ``depth``.
    Sorted, neighbours share their longest prefix with what is open."""
    nodes: list[list] = []  # conv_id, depth, parent's index, n_convs, n_children, n_leaves, saved, ends, words
    stack: list[int] = []

    def close() -> None:
        node = nodes[stack.pop()]
        if not node[4]:
            node[5] = 1
        node[6] += (node[3] - 1) * node[8]
        if stack:
            above = nodes[stack[-1]]
            above[0] = min(above[0], node[0])
            above[3] += node[3]
            above[4] += 1
            above[5] += node[5]
            above[6] += node[6]

    before: list[bytes] = []
    for ids, words, conv, copies, ends in sorted(entries, key=lambda e: e[0]):
        same = 0
        while same < len(before) and same < len(ids) and before[same] == ids[same]:
            same += 1
        while len(stack) > same:
            close()
        for k in range(same, len(ids)):
            nodes.append([conv, depth + k, stack[-1] if stack else -1, 0, 0, 0, 0, _NO_ENDS, words[k]])
            stack.append(len(nodes) - 1)
        last = nodes[stack[-1]]
        last[0] = min(last[0], conv)
        last[3] += copies
        last[7] = ends
        before = ids
    while stack:
        close()
    return [[n[0], n[1], parent if n[2] < 0 else nodes[n[2]][0], *n[3:8]] for n in nodes]


def _swept(rows: DataFrame) -> DataFrame:
    """Nodes of all containers, from (container, depth, above, rep, n, len,
    ends, pos, id, words); a container's rows are in one task, in order."""
    schema = pa.schema([*[(c, pa.string() if c == "ends_sha256" else pa.int64()) for c in NODE_COLUMNS], ("container", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        container, depth, above, entries = None, 0, None, []

        def done(out: list[list]) -> None:
            for i, node in enumerate(sweep(entries, depth, above)):
                out.append([*node, None if i else container])

        for batch in batches:
            out: list[list] = []
            for r in batch.to_pylist():
                if r["container"] != container:
                    if entries:
                        done(out)
                    container, depth, above, entries = r["container"], r["depth"], r["above"], []
                if not entries or entries[-1][2] != r["rep"]:
                    entries.append(([], [], r["rep"], r["n"], r["ends"]))
                entries[-1][0].append(r["id"])
                entries[-1][1].append(r["words"])
            yield pa.RecordBatch.from_arrays([pa.array([n[i] for n in out], f.type) for i, f in enumerate(schema)], schema=schema)
        if entries:
            out = []
            done(out)
            yield pa.RecordBatch.from_arrays([pa.array([n[i] for n in out], f.type) for i, f in enumerate(schema)], schema=schema)

    dealt = rows.repartition("container").sortWithinPartitions("container", "rep", "pos")
    return dealt.mapInArrow(task, NODE + ", container binary")


def prefix_trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, the root included.

    Columns as in ``NODE``.  Turns are ordered by ``turn`` (null first), ties
    by role and text, repeated rows are turns of their own; null role or text
    is empty, a null ``conv_id`` is no conversation, ``%`` is SQL's (it keeps the
    sign).  Other columns are not
    read.  An empty table has no conversation and no node.  A round of
    bursting goes one turn deeper, so there are as many rounds as turns that
    more than ``container`` turns of different conversations share."""
    convs, turns = rebuilt(ranked_turns(conversations))
    entries = _entries(convs, turns)
    turns = cut(split_join(turns, entries.select(F.col("rep").alias("conv_id"), "n", "len"), ["conv_id"]).select(
        F.col("conv_id").alias("rep"), "pos", "id", "words", "rest", "n", "len"))
    root = F.lit(b"").cast("binary")
    least = entries.agg(F.min("rep")).first()[0]
    open_ = entries.select("rep", "n", "len", "ends", root.alias("container"), F.array(root).alias("path"), F.lit(least).cast("long").alias("top"),
                           F.lit(None).cast("long").alias("above"), F.lit(0).cast("long").alias("words"))
    depth, heads, closed, chains = 0, [], [], []
    while True:
        # one turn deeper: (container, id) names the next container
        step = turns.where(F.col("pos") == depth).select(F.col("rep").alias("__rep"), "id", F.col("words").alias("next_words"))
        nexts = cut(open_.where(F.col("len") > depth).join(step, F.col("rep") == F.col("__rep")).select(
            "rep", "n", "len", "ends", "path", F.col("container").alias("parent"), F.col("top").alias("above"),
            F.unhex(F.substring(F.sha2(F.concat("container", "id"), 256), 1, 32)).alias("container"), F.col("next_words").alias("words")))
        sizes = cut(nexts.groupBy("container").agg(F.first("parent").alias("parent"), F.min("rep").alias("top"), F.count(F.lit(1)).alias("entries"),
                                                   F.sum(F.col("len") - depth).alias("turns")))
        children = sizes.groupBy(F.col("parent").alias("container")).agg(F.count(F.lit(1)).alias("n_children"))
        heads.append(cut(open_.groupBy("container").agg(
            F.min("rep").alias("conv_id"), F.first("above").alias("above"), F.sum("n").alias("n_convs"), F.first("words").alias("words"),
            F.first("path").alias("path"), F.max(F.when(F.col("len") == depth, F.col("ends"))).alias("ends")).join(
                children, "container", "left").withColumn("depth", F.lit(depth).cast("long"))))
        depth += 1
        large = cut(sizes.where(F.col("turns") > container).select("container", "top", "entries"))
        marked = _marked(nexts.drop("parent"), large).withColumn("depth", F.lit(depth).cast("long"))
        closed.append(marked.where("entries is null"))
        if not large.count():
            break
        chains.append(marked.where("entries = 1"))
        open_ = cut(marked.where("entries > 1").drop("entries", "depth").withColumn("path", F.array_append("path", F.col("container"))))
    held, alone = (cut(reduce(DataFrame.unionByName, parts)) if parts else None for parts in (closed, chains))
    chain = None if alone is None else small_or_shuffled(alone.select(F.col("rep").alias("__rep"), "ends", "depth", "above", "path"), 256)
    several = turns if chain is None else turns.join(chain, F.col("rep") == F.col("__rep"), "left_anti")
    suffix = held.select("container", "depth", "above", F.col("rep").alias("__rep"), "ends").join(
        several, (F.col("rep") == F.col("__rep")) & (F.col("pos") >= F.col("depth") - 1)).select(
        "container", "depth", "above", "rep", "n", "len", "ends", "pos", "id", "words")
    nodes = cut(_swept(suffix))
    below = nodes.where(F.col("container").isNotNull()).select("container", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    paths = held.groupBy("container").agg(F.first("path").alias("path"))
    up = below.join(paths, "container").select("path", "leaves", "saved")
    out = nodes.select(*NODE_COLUMNS)
    if chain is not None:
        rows = turns.join(chain, (F.col("rep") == F.col("__rep")) & (F.col("pos") >= F.col("depth") - 1))
        saved = (F.col("n") - 1) * F.col("rest")
        ended = F.col("pos") + 1 == F.col("len")
        top = F.col("pos") + 1 == F.col("depth")
        out = out.unionByName(rows.select(
            F.col("rep").alias("conv_id"), (F.col("pos") + 1).alias("depth"), F.when(top, F.col("above")).otherwise(F.col("rep")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"), F.when(ended, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
            saved.alias("saved_tokens"), F.when(ended, F.col("ends")).otherwise(_NO_ENDS).alias("ends_sha256")))
        up = up.unionByName(rows.where(top).select("path", F.lit(1).cast("long").alias("leaves"), saved.alias("saved")))
    top = reduce(DataFrame.unionByName, heads)
    own = top.select("path", F.lit(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    sums = up.unionByName(own).select(F.explode("path").alias("container"), "leaves", "saved").groupBy("container").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    children = F.coalesce("n_children", F.lit(0))
    return out.unionByName(top.join(sums, "container").select(
        "conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", children.alias("n_children"),
        F.when(children == 0, 1).otherwise(F.col("leaves")).alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256")))


def _marked(rows: DataFrame, large: DataFrame) -> DataFrame:
    """``rows`` with ``top`` and ``entries`` of their container, null if it
    is not one of ``large``."""
    if large.count() * 64 <= BROADCAST_BYTES:
        return rows.join(F.broadcast(large), "container", "left")
    return split_join(rows, large, ["container"], "left")
