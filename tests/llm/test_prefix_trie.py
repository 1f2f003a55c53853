"""The conversation trie against a brute-force trie."""

import hashlib
import math
import random
import re
import zlib

import pytest

from estatelens.llm import prefix_trie
from estatelens.llm.queries import op12_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, n_convs string, Depth int"
SF = "/root/testdata/sf0.01"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c in own:
        own[c] = [(r, t) for _, _, r, t in sorted(own[c])]
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h]) + tuple(turns[h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    out = {}

    for node in sorted(members, key=len, reverse=True):
        below = [out[k] for k in kids.get(node, [])]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        ends = ",".join(str(c) for c in sorted(members[node]) if len(seqs[c]) == len(node))
        out[node] = (min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
                     sum(b[5] for b in below) if below else 1, (len(members[node]) - 1) * words + sum(b[6] for b in below),
                     hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def nodes(df):
    return sorted((tuple(r[c] for c in prefix_trie.NODE_COLUMNS) for r in df.collect()), key=str)


def small_rows():
    r = random.Random(5)
    say = lambda: " ".join(r.choice(["a", "b", "c\n"]) for _ in range(r.randrange(3)))
    rows = [(c, t, r.choice(["user", "assistant"]), say()) for c in range(0, 130) for t in range(r.randrange(0, 6)) if c % 7]
    rows += [(0, t, "user", "hi there") for t in range(2)] + [(20, 0, "system", "be good"), (20, 1, "user", "a b")]
    rows += [(1000 + i, t, "user", f"turn {t}") for i in range(30) for t in range(4)]  # copies
    rows += [(2000, t, "user", f"word {t % 3}") for t in range(52)] + [(2003, t, "user", f"word {t % 3}") for t in range(44)]
    rows += [(3, None, None, None), (3, None, "user", None), (3, 0, None, "tie b"), (3, 0, None, "tie a"), (3, 0, None, "tie a"), (None, 0, "user", "x")]
    rows += [(5000, 0, "user", "long " * 40000), (5001, 0, "user", ""), (-7, 0, "user", "negative"), (-7, 1, "user", "negative")]
    return rows


@pytest.mark.parametrize("container", [1, 40, 1 << 20])
def test_trie(spark, container):
    rows = small_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    if container == 1:
        few = [r for r in rows if r[0] is None or r[0] < 1500]
        assert nodes(prefix_trie.prefix_trie(df.where("conv_id is null or conv_id < 1500"), 1)) == brute(few)
    else:
        assert nodes(prefix_trie.prefix_trie(df, container)) == brute(rows)


def test_empty(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = spark.createDataFrame([(1, 0, "user", "only", "", 0)], SCHEMA)
    assert nodes(prefix_trie.prefix_trie(lone)) == brute([(1, 0, "user", "only")])


def test_whole_table(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert nodes(op12_prefix_trie(spark, SF)) == brute(rows)
