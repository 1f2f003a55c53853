"""Operators of ``estatelens.llm`` against brute force on small tables with
nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

from estatelens.llm import (chat, components, decontaminate, exact_dedup, html_extract, language, packing, simhash, substring_dedup,
                            suffix_dedup, url_filter)
from estatelens.llm.shared import cut

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, MASK int"


def make_docs():
    r = random.Random(3)
    vocab = ["".join(r.choice("abcdeéß日") for _ in range(r.randrange(2, 6))) for _ in range(60)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    passage, line = say(60), say(5)
    texts = [None, "", " \n\t", "one", "ONE", "one", "12 34 !!", line]
    texts += [say(r.randrange(1, 90)) for _ in range(30)]
    texts += [say(5) + "\n" + passage + " " + say(7) for _ in range(6)]
    texts += ["x " * 400, (line + "\n") * 60, passage.upper(), passage, passage, "ab" * 3000]
    near = say(300).split()
    texts += [" ".join(near[:i] + ["zz"] + near[i + 1:]) for i in (3, 150, 290)] + [" ".join(near)]
    rows = [(i, t, ["en", "de"][i % 2], "s", len(t or ""), "k", 1) for i, t in enumerate(texts)]
    return rows + [rows[12]]  # a repeated row


@pytest.fixture(scope="module")
def rows():
    return make_docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *cols):
    return sorted((tuple(r[c] for c in ("doc_id", *cols)) for r in df.collect()), key=str)


def expect(rows, f):
    return sorted(((r[0], *f(r[0], r[1])) for r in rows), key=str)


def test_exact_dedup(docs, rows, empty):
    norm = lambda t: (t or "").translate(LOWER)
    size, top = Counter(norm(r[1]) for r in rows), {}
    for r in rows:
        top[norm(r[1])] = max(top.get(norm(r[1]), -1), r[0])
    out = exact_dedup.exact_dedup(docs)
    assert out.columns.count("kept") == 1 and "MASK" in out.columns
    assert by_id(out, "keep_id", "group_size", "kept", "text_sha256") == expect(rows, lambda i, t: (
        top[norm(t)], size[norm(t)], i == top[norm(t)], hashlib.sha256(norm(t).encode()).hexdigest()))
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_dense_filter(docs, rows, monkeypatch):
    want = by_id(exact_dedup.exact_dedup(docs), "keep_id", "group_size")
    monkeypatch.setattr(exact_dedup, "BITS_PER_ROW", 0)
    assert by_id(exact_dedup.exact_dedup(docs), "keep_id", "group_size") == want


def brute_simhash(t):
    w = WORD.findall((t or "").translate(LOWER))
    h = [xxhash.xxh64_intdigest(" ".join(w[j:j + 3]).encode(), 42) for j in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, rows, empty):
    fp = {r[0]: brute_simhash(r[1]) for r in rows}
    root = {i: i for i in fp}
    changed = True
    while changed:
        changed = False
        for i in fp:
            for j in fp:
                if (fp[i] ^ fp[j]).bit_count() <= 3 and root[j] < root[i]:
                    root[i], changed = root[j], True
    out = simhash.simhash_components(docs).withColumn("hex", simhash.hex_digits(F.col("fp")))
    assert by_id(out, "hex", "component_id") == expect(rows, lambda i, t: (f"{fp[i]:016x}", root[i]))
    assert simhash.simhash_components(empty).count() == 0


@pytest.mark.parametrize("longest", [1, 4, 256])
def test_near_links_are_complete(spark, longest):
    """Dense clusters go through every level of the index."""
    r = random.Random(longest)
    centres = [r.getrandbits(64) for _ in range(4)]
    fps = {0, 1, (1 << 64) - 1}
    for c in centres:
        for _ in range(60):
            x = c
            for _ in range(r.randrange(5)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    groups = Counter(find(x) for x in fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    links = simhash.near_links(df, longest=longest).distinct()
    found = simhash.components(links).groupBy("root").count().collect()
    assert sorted(x["count"] for x in found) == sorted(n for n in groups.values() if n > 1)


def test_near_links_name_the_least(spark):
    """A chain of near fingerprints in one list is a star at once."""
    chain = [0, 0b111, 0b111111, 0b111111111]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in chain], "fp long")).distinct().collect()
    assert sorted((max(x), min(x)) for x in links) == [(x, 0) for x in chain[1:]]
    tail = [0, 0b1111, 0b10011]  # 0b1111 is only ever the lesser of a pair
    links = simhash.near_links(spark.createDataFrame([(x,) for x in tail], "fp long")).distinct()
    assert {tuple(x) for x in simhash.components(links).collect()} == {(x, 0) for x in tail}


@pytest.mark.parametrize("broadcast", [0, 16 << 20])
def test_components_take_few_steps(spark, monkeypatch, broadcast):
    r = random.Random(3)
    edges = {(r.randrange(-300, 300), r.randrange(-300, 300)) for _ in range(260)} | {(x, x + 1) for x in range(1000, 1040)}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    monkeypatch.setattr(components, "BROADCAST_BYTES", broadcast)
    found = components.components(spark.createDataFrame(list(edges), "a long, b long")).collect()
    lone = {a for a, b in edges if a == b and sum(a in e for e in edges) == 1}
    assert Counter(map(tuple, found)) == Counter((x, y) for x, y in root.items() if x not in lone)
    plans = []

    def counted(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return cut(df)

    monkeypatch.setattr(components, "cut", counted)
    star = spark.createDataFrame([(x, 0) for x in range(1, 9)], "a long, b long")
    assert components.components(star).count() == 9
    assert len(plans) == 3  # one round tells that stars are done


def test_decontaminate(spark, docs, rows, empty):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    texts = {r[0]: r[1] for r in rows}
    items = [(1, " ".join(texts[40].split()[10:35])), (2, "ONE"), (3, None), (4, ""), (10, "-- !!"), (11, texts[20]), (11, texts[20])]
    windows = {}
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        k = min(13, len(w))
        windows.setdefault(str(i), set()).update(tuple(w[j:j + k]) for j in range(len(w) - k + 1) if k)

    def want(i, t):
        w = word.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for item, seqs in windows.items():
            for s in seqs:
                for j in range(len(w) - len(s) + 1):
                    if tuple(w[j:j + len(s)]) == s:
                        hit.update(range(j, j + len(s)))
                        found.add(item)
        ids = ",".join(sorted(found))
        return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)

    bench = spark.createDataFrame(items, "item_id long, text string")
    cols = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    expected = expect(rows, want)
    assert any(e[5] for e in expected)
    assert by_id(decontaminate.judged(decontaminate.contamination(docs, bench)), *cols) == expected
    assert by_id(decontaminate.judged(decontaminate.contamination(docs, bench, block_bytes=10)), *cols) == expected
    kept = [r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()]
    assert sorted(kept) == sorted(e[0] for e in expected if not e[5])
    assert not any(r["contaminated"] for r in decontaminate.judged(decontaminate.contamination(docs, bench.limit(0))).collect())
    assert decontaminate.contamination(empty, bench).count() == 0


@pytest.mark.parametrize("window", [3, 8, 35])
def test_substring_dedup(docs, rows, empty, window):
    words = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    seen = Counter(tuple(w[j:j + window]) for _, w in words for j in range(len(w) - window + 1))

    def want(_, t):
        w = WORD.findall(t or "")
        gone = {k for j in range(len(w) - window + 1) if seen[tuple(w[j:j + window])] > 1 for k in range(j, j + window)}
        return len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)

    assert by_id(substring_dedup.substring_dedup(docs, window), "n_words", "n_removed", "kept_text") == expect(rows, want)
    assert substring_dedup.substring_dedup(empty, window).count() == 0


@pytest.mark.parametrize("group, window", [(1 << 20, 100), (2000, 100), (1, 20)])
def test_suffix_dedup(docs, rows, empty, monkeypatch, group, window):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    seen, result = set(), {}
    for i, t in sorted({(r[0], r[1] or "") for r in rows}):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - window + 1):
            if b[j:j + window] in seen:
                gone[j:j + window] = True
            seen.add(b[j:j + window])
        n_spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        result[i] = (len(b), int(gone.sum()), n_spans, np.frombuffer(b, np.uint8)[~gone].tobytes())
    out = suffix_dedup.suffix_dedup(docs, window).withColumn("kept_bytes", F.hex("kept_bytes"))
    want = expect(rows, lambda i, t: (*result[i][:3], result[i][3].hex().upper()))
    assert by_id(out, "n_bytes", "n_removed", "n_spans", "kept_bytes") == want
    assert suffix_dedup.suffix_dedup(empty, window).count() == 0


def test_suffix_ranks():
    r = np.random.default_rng(1)
    text = r.integers(97, 99, 500).astype(np.uint8)
    for length in (5, 8, 20, 100):
        at = np.arange(500 - length)
        strings = [text[i:i + length].tobytes() for i in at]
        order = {s: k for k, s in enumerate(sorted(set(strings)))}
        assert suffix_dedup.suffix_ranks(text, at, length).tolist() == [order[s] for s in strings]


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.public_tokenizer_path())
    odd = [(900, "a\u00a0 b\u3000c  d'll say <|endoftext|> it's\x85 1st.\r\n\n x"), (901, "naïve…... 12.5%  ")]
    all_rows = rows + [(i, x, "en", "s", 0, "k", 1) for i, x in odd]
    both = docs.unionByName(docs.sparkSession.createDataFrame(all_rows[-2:], SCHEMA))
    got = packing.pack(both).collect()
    assert len({p["sequence_id"] for p in got}) == len(got)
    want = Counter()
    for i, x in [(r[0], r[1]) for r in all_rows]:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        at = 0
        for k in packing.piece_lengths(len(ids)):
            want[i, at, k, zlib.crc32(np.array(ids[at:at + k], "<u4").tobytes()), len(ids), 0, tuple(ids[at:at + k])] += 1
            assert k & (k - 1) == 0 and k <= 1024
            at += k
        assert at == len(ids)
    assert Counter((p["doc_id"], p["start"], p["length"], p["ids_crc32"], p["doc_tokens"], p["offset"], tuple(p["input_ids"])) for p in got) == want
    assert packing.pack(empty).count() == 0


def test_packing_encodes_new_units_together(monkeypatch):
    """Units not met before share texts; ids and counts are those of whole texts."""
    r = random.Random(8)
    path = packing.public_tokenizer_path()
    special = packing.Encoder(path)._special[0]
    words = ["".join(r.choice("abcXYZ09é日'(.,-<|>") for _ in range(r.randrange(1, 9))) for _ in range(3000)]
    cut_up = re.split("(?<=[a-z0-9])(?=[^a-z0-9])", special)  # two units that would be the token side by side
    texts = ["".join(r.choice([" ", "\n", "  ", "\t", ""]) + w for w in r.sample(words, 40)) for _ in range(200)]
    texts += ["", None, " ", "x \n", "a\u00a0b " + words[0], special, f"x {special} y", " " + words[1] * 30, " ".join(words)]
    texts += [f"x y{cut_up[0]}", *[f"z {cut_up[0][-1]}{c}" for c in cut_up[1:]]]
    for run in (1, 2, packing.RUN):
        monkeypatch.setattr(packing, "RUN", run)
        encoder, asked = packing.Encoder(path), []
        tell = encoder._texts
        monkeypatch.setattr(encoder, "_texts", lambda t: asked.append(len(t)) or tell(t))
        for _ in range(2):  # the second time nearly all are known
            a = pa.array(["" if x is None else x for x in texts], pa.large_string())
            raw = [x.encode() for x in a.to_pylist()]
            offsets = np.cumsum([0, *map(len, raw)])
            ids, n = encoder.chunk(a, np.frombuffer(b"".join(raw), np.uint8), offsets)
            whole = [e.ids for e in encoder._tokenizer.encode_batch_fast(a.to_pylist(), add_special_tokens=False)]
            assert n.tolist() == [len(w) for w in whole] and ids.tolist() == [i for w in whole for i in w]
    assert asked[0] < len(encoder._known) / 3 and sum(asked[1:]) <= 10
    units = pa.array([b" x" + cut_up[0].encode(), *[c.encode() for c in cut_up[1:]], b" y"], pa.binary())
    ids, n = encoder._encode(units, np.zeros(len(units), bool))
    apart = [encoder._tokenizer.encode(u.decode(), add_special_tokens=False).ids for u in units.to_pylist()]
    assert n.tolist() == [len(w) for w in apart] and ids.tolist() == [i for w in apart for i in w]
    encoder._bytes[:] = 1  # ids do not tell where units end
    assert [x.tolist() for x in encoder._encode(units, np.zeros(len(units), bool))] == [ids.tolist(), n.tolist()]


def test_language(spark, empty):
    r = random.Random(5)
    words = {"en": ["the", "and", "thing", "other", "over"], "fr": ["élan", "que", "les", "eaux", "où"]}
    rows = [(i, " ".join(r.choice(words[k]) for _ in range(30)), k) for i in range(120) for k in [["en", "fr"][i % 2]]]
    rows += [(500, None, "en"), (501, "", "fr"), (502, "12 !! 34", "en"), (503, "the thing " * 5000, None), (503, "the thing " * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("Score", F.lit("x"))
    out = language.identify(docs).collect()
    assert len(out) == len(rows)
    got = {x["doc_id"]: x for x in out}
    assert all(got[i]["lang_pred"] == k and not got[i]["rejected"] for i, _, k in rows[:120])
    assert all(got[i]["lang_pred"] == "und" and got[i]["rejected"] and got[i]["score"] == 0 for i in (500, 501, 502))
    assert got[503]["lang_pred"] == "en" and 0 <= got[503]["score"] <= 1
    swapped = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("fr")).otherwise(F.col("lang")))
    assert sorted(map(str, language.identify(swapped).select("doc_id", "lang_pred", "score").collect())) == sorted(
        map(str, language.identify(docs).select("doc_id", "lang_pred", "score").collect()))
    assert language.identify(empty).count() == 0
    nothing = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {x["lang_pred"] for x in nothing} == {"und"}
    assert language.keep_identified(docs).columns == docs.columns


def test_url_filter(spark):
    pages = [(1, "http://a.example.org/es/x?q=1"), (2, "HTTP://WWW.Example.org/en/12"), (3, "https://example.org/en/2"), (4, "http://x.com/de/1#f"),
             (5, "x://com/fr/"), (6, None), (7, "no scheme"), (8, "http://org"), (9, "http://notexample.org/es/"), (9, "http://notexample.org/es/")]
    pages += [(100 + i, f"http://spam.net/buy/{i}") for i in range(40)] + [(200 + i, f"http://fine.net/read/{i}") for i in range(60)]
    labels = [(100 + i, 0, 0) for i in range(30)] + [(200 + i, 1, 0) for i in range(50)] + [(200, None, None), (None, 1, 1)]
    p = spark.createDataFrame(pages, "page_id long, url string").withColumn("Host", F.lit(1))
    rules = url_filter.mine(p, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rules.count() and all(r["confidence"] >= url_filter.MIN_CONFIDENCE for r in rules.collect())
    out = url_filter.url_filter(p, rules).collect()
    assert len(out) == len(pages)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("www.example.org", "/en/12", "example.org/en/1", "block")
    assert got[3] == ("example.org", "/en/2", "org/", "allow")
    assert got[4] == ("x.com", "/de/1", "com/de/", "block")
    assert got[5] == ("com", "/fr/", "com/fr/", "allow")
    assert got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("org", "", None, "allow")
    assert got[9] == ("notexample.org", "/es/", "org/", "allow")
    assert all(got[100 + i][3] == "block" for i in range(40)) and all(got[200 + i][3] == "allow" for i in range(60))
    none = url_filter.mine(p.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert none.count() == 0 and url_filter.url_filter(p.limit(0), none).count() == 0


def test_html(spark):
    page = ("<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><nav><a>menu</a></nav>"
            "<header>head</header><div class='cookie-notice'>cookies</div><main><article class=post><h1>Ti&amp;tle</h1>"
            "<p><b>One  &eacute;\n two<br><p>Three <a href=x>four</a>.<div class='ad-box'>buy</div><form>f</form><ul><li>a<li>b</ul>"
            "<section id=comments>said</section></article><aside>side</aside></main><footer>&copy; foot</footer></body></html>")
    same = [f"<body><div class=x>Everywhere</div><div class=y>Only {i}</div></body>" for i in range(25)]
    rows = [(1, "http://h/1", page), (2, None, None), (3, "http://h/2", ""), (4, "http://h/3", "plain <b>text"), (5, "u", "<p>cut <a hre"), (5, "u", "<p>cut <a hre")]
    rows += [(10 + i, "http://same/" + str(i), h) for i, h in enumerate(same)]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("shape", F.lit(1))).collect()
    got = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows)
    assert got[1] == "Ti&tle\nOne é two\nThree four.\na\nb"
    assert got[2] == got[3] == "" and got[4] == "plain text" and got[5] == "cut"
    assert all(got[10 + i] == f"Only {i}" for i in range(25))


def test_tree_matching():
    a = html_extract.tree(["/b", "/b/n", "/b/a", "/b/a/p", "/b/f"])
    b = html_extract.tree(["/b", "/b/x", "/b/a", "/b/a/h", "/b/a/p", "/b/f"])
    n, pairs = html_extract.match(a, b)
    assert n == 5 and dict(pairs)["/b/a/p"] == "/b/a/p" and "/b/n" not in dict(pairs)


def test_chat(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", "é日"), (1, 3, "ann", "é日"),
            (2, None, None, "x"), (None, 1, "ann", "y"), (3, 0, "system", "alone")] + [(4, i, "u" if i % 2 else "v", str(i)) for i in range(600)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("Speaker", F.lit(0))
    out = {(r["conv_id"], r["speaker"], r["part"]): r for r in chat.rotate(turns).collect()}
    assert {k[:2] for k in out} == {(1, "ann"), (1, "bob"), (2, "unknown"), (None, "ann"), (4, "u"), (4, "v")}
    r = out[1, "ann", 0]
    assert r["text"] == ("<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user|>\nbob: <|end|>\n" + 2 * "<|assistant|>\né日<|end|>\n")
    assert [r["text"][m["first"]:m["first"] + m["length"]] for m in r["mask"]] == ["hi<|end|>", "é日<|end|>", "é日<|end|>"]
    assert [out[4, "u", p]["n_turns"] for p in range(3)] == [256, 256, 88]
    lanes = chat.rotate(turns, part_rows=100).where("conv_id = 4 and speaker = 'u'").collect()
    assert sum(x["n_turns"] for x in lanes) == 600 and max(x["lane"] for x in lanes) > 0
    assert chat.rotate(turns.limit(0)).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = make_docs()[:-1]
    spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([Row(item_id=1, text=rows[20][1])]).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns, name
        assert left.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in left.collect()}


def test_html_aligned_nodes(spark):
    """The notice is the second div of some pages and the first of others,
    under a class of its own, on a host of three pages and one of five."""
    def page(i, ads):
        return (f"<body>{''.join(f'<div>ad {i} {k}</div>' for k in range(ads))}<div class=p{i}><ul><li>Notice</ul></div>"
                f"<section>{''.join(f'<p>Text {i} {k}</p>' for k in range(1 + i))}</section></body>")

    rows = [(100 * n + i, f"http://h{n}/{i}", page(i, i % 2)) for n in (3, 5) for i in range(n)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = lambda: {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    want = {100 * n + i: "\n".join([f"ad {i} {k}" for k in range(i % 2)] + [f"Text {i} {k}" for k in range(1 + i)])
            for n in (3, 5) for i in range(n)}
    assert texts() == want
    a, b = html_extract.parse(page(0, 0))[0], html_extract.parse(page(1, 1))[0]
    pairs = dict(html_extract.match(html_extract.tree(a), html_extract.tree(b))[1])
    assert pairs["/body[1]/div[1]/ul[1]/li[1]"] == "/body[1]/div[2]/ul[1]/li[1]"


def brute_match(a, b):
    if a.label != b.label:
        return 0
    best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_match(x, y))
    return best[-1][-1] + 1


@pytest.mark.parametrize("cells", [1, 1 << 22])
def test_match_is_largest(monkeypatch, cells):
    monkeypatch.setattr(html_extract, "CELLS", cells)
    r = random.Random(cells)

    def shape(path="", depth=0):
        out, seen = [], Counter()
        for _ in range(r.randrange(max(1, 6 - depth))):
            t = r.choice("ab")
            seen[t] += 1
            out += [f"{path}/{t}[{seen[t]}]", *shape(f"{path}/{t}[{seen[t]}]", depth + 2)]
        return out

    differ = 0
    for _ in range(100):
        x, y = shape(), shape()
        n, pairs = html_extract.match(html_extract.tree(x), html_extract.tree(y))
        assert n == len(pairs) == len(dict(pairs)) == len({q for _, q in pairs}) == brute_match(html_extract.tree(x), html_extract.tree(y))
        assert all(re.sub(r"\[.*?\]", "", p) == re.sub(r"\[.*?\]", "", q) for p, q in pairs)
        differ += sum(p != q for p, q in pairs)
    assert differ


def test_url_filter_joins_labels_by_document(spark, tmp_path):
    from estatelens.llm import queries

    ids = [f"https://spam.net/en/{7000 + i}{e}" for i in range(30) for e in ("", "/", ".html?ref=1")]
    got = spark.createDataFrame([(u,) for u in [*ids, "https://h/en", None, "https://h/99999999999999999999"]], "url string").select(
        url_filter.document_id(F.col("url")).alias("d")).collect()
    assert [x["d"] for x in got] == [7000 + i for i in range(30) for _ in range(3)] + [None] * 3
    pages = [(i, f"https://spam.net/en/{7000 + i}") for i in range(30)] + [(100 + i, f"https://fine.net/en/{i}") for i in range(60)]
    labels = [(7000 + i, 0, 0) for i in range(30)] + [(i, 1, 0) for i in range(60)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = {r["page_id"]: r["verdict"] for r in queries.op3_url_filter(spark, str(tmp_path)).collect()}
    assert all(v == ("block" if i < 100 else "allow") for i, v in out.items())


def test_url_filter_floor_and_lift(spark):
    """25 bad pages make a rule among 40,000; a share of bad pages as in the
    whole table makes none."""
    pages = spark.range(40000).selectExpr("id AS page_id", "concat('http://', if(id < 25, 'spam', 'fine'), '.net/x/', id) AS url")
    rules = url_filter.mine(pages, pages.selectExpr("page_id AS doc_id", "if(page_id < 25, 0, 1) AS quality", "0 AS toxic")).collect()
    assert {t for r in rules for t in r["tokens"]} == {"host:spam.net", "label:spam"}
    even = pages.limit(1000).selectExpr("page_id AS doc_id", "if(page_id % 10 < 7, 0, 1) AS quality", "0 AS toxic")
    assert all(r["confidence"] > 0.7 for r in url_filter.mine(pages.where("page_id >= 25"), even).collect())


def test_chat_lanes_are_consecutive(spark):
    rows = [(c, t, r, f"{t}.{k}") for c in (None, 1) for t in (None, 0, 1) for r in ("ann", "bob") for k in range(40)]
    rows += [(None, None, "ann", "same")] * 70
    random.Random(1).shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    whole = {(r["conv_id"], r["speaker"], r["part"]): r["text"] for r in chat.rotate(turns).collect()}
    lanes = chat.rotate(turns, part_rows=32).collect()
    assert max(r["n_turns"] for r in lanes) == 32 and len(lanes) > 20
    joined = {}
    for r in sorted(lanes, key=lambda r: r["lane"]):
        key = r["conv_id"], r["speaker"], r["part"]
        joined[key] = joined.get(key, "") + r["text"]
    assert joined == whole


def test_near_dedup_repeated_ids(spark):
    r = random.Random(9)
    say = lambda: [r.choice("abcdefgh") + str(r.randrange(500)) for _ in range(400)]
    a, b, c, d = say(), say(), say(), say()
    near = lambda w: " ".join([*w[:200], "zz", *w[200:]])
    rows = [(7, " ".join(a)), (9, near(a)), (7, " ".join(b)), (3, near(b)), (None, " ".join(c)), (5, near(c)), (None, " ".join(d)),
            (11, "x"), (11, "x"), (11, "X"), (None, "y"), (None, "y")]
    docs = spark.createDataFrame([(*x, i) for i, x in enumerate(rows)], "doc_id long, text string, row int")
    assert all((brute_simhash(x) ^ brute_simhash(y)).bit_count() <= 3 for x, y in ((rows[0][1], rows[1][1]), (rows[2][1], rows[3][1]), (rows[4][1], rows[5][1])))
    out = simhash.near_dedup(docs)
    assert out.columns == docs.columns
    assert Counter((x["doc_id"], (x["text"] or "").lower()) for x in out.collect()) == Counter(
        [(7, " ".join(a)), (3, near(b)), (5, near(c)), (None, " ".join(d)), (11, "x"), (None, "y")])
    assert Counter((x["doc_id"], x["text"].lower()) for x in exact_dedup.drop_copies(docs).collect()) == Counter(
        [*rows[:7], (11, "x"), (None, "y")])


def test_language_keeps_outliers():
    """A few odd texts neither make clusters nor thresholds of their own."""
    r = np.random.default_rng(4)
    x = np.abs(r.normal(size=(400, 64))).astype(np.float32) * (1 + 4 * (np.arange(64) < 8))
    x[:6] = np.eye(64, dtype=np.float32)[20:26]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c, member = language._cluster(x, 4)
    assert np.bincount(member, minlength=len(c)).min() >= language.MIN_MEMBERS


def test_pipeline_rows_hold_token_ids(spark, docs):
    import corpus_pipeline

    pieces = corpus_pipeline.pack_documents(spark, docs.select("doc_id", "text"), "").collect()
    assert pieces and all(len(p["input_ids"]) == p["length"] and zlib.crc32(np.array(p["input_ids"], "<u4").tobytes()) == p["ids_crc32"] for p in pieces)
