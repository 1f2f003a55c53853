"""Language ID, URL rules and the whole pipeline restated in plain Python."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row

from estatelens.llm import language, packing, url_filter
from estatelens.llm.queries import op2_language

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    """Slot counts of a text's grams of two and three bytes."""
    b = [x if x >= 0x80 or 0x61 <= x <= 0x7A else 0x20 for x in (text or "").translate(LOWER).encode()]
    out = Counter()
    for size in (2, 3):
        for i in range(len(b) - size + 1):
            code = 0
            for x in b[i:i + size]:
                code = code << 8 | x
            out[(code * 2654435761 + size * 97) % 2**32 >> 20] += 1
    return out


def nearest(text, model):
    """(language, cosine, rejected) by the cosine with every centroid."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, True
    x = {k: math.log1p(n) * float(model.idf[k]) for k, n in grams(text).items()}
    norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
    cosine = [sum(v * float(c[k]) for k, v in x.items()) / norm for c in model.centroids]
    best = max(range(len(cosine)), key=cosine.__getitem__)
    return model.langs[best], cosine[best], cosine[best] < model.least[best]


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs)
    rows = docs.select("doc_id", "text", "lang").collect()
    train = [r for r in rows if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    seen = Counter(k for r in train for k in grams(r["text"]))
    want = np.array([math.log((1 + len(train)) / (1 + seen[k])) + 1 for k in range(language.FEATURES)])
    assert np.abs(model.idf - want).max() < 1e-5
    got = {r["doc_id"]: r for r in op2_language(spark, SF).collect()}
    right = held = 0
    for r in rows:
        lang, score, rejected = nearest(r["text"], model)
        out = got[r["doc_id"]]
        assert out["lang_pred"] == lang and out["rejected"] == rejected and abs(out["score"] - score) < 1e-4
        assert out["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        if out["held_out"] and r["lang"] is not None and lang != "und":
            held += 1
            right += lang == r["lang"]
    assert held and right / held > 0.95


def url_tokens(url):
    host, path = "", ""
    if "://" in (url or ""):
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(LOWER)
    return {f"host:{host}", f"depth:{len(path.split('/'))}", *(f"label:{x}" for x in host.split(".")),
            *("path:" + re.sub(r"[0-9]+", "#", x) for x in re.split(r"[/.]+", path) if x)}


def test_url_rules_on_given_pages(spark):
    """Planted labels for the given pages; rules by trying all token sets."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    rows = pages.collect()
    r = random.Random(3)
    sets = {p["page_id"]: frozenset(url_tokens(p["url"])) for p in rows}
    often = Counter(t for s in sets.values() for t in s if t.startswith("host:"))
    spam = {t for t, n in often.items() if n >= 15 and t != "host:"}
    bad = {i: bool(s & spam) and r.random() < 0.9 for i, s in sets.items()}
    labels = spark.createDataFrame([(i, 0 if b else 1, 0) for i, b in bad.items()], "doc_id long, quality int, toxic int")
    least = 8
    rules = {tuple(x["tokens"]): (x["confidence"], x["support"]) for x in url_filter.mine(pages, labels, min_pages=least).collect()}
    n, n_bad = len(sets), sum(bad.values())
    found = {}
    counted = Counter(t for i, s in sets.items() if bad[i] for t in s)
    usable = sorted(t for t, k in counted.items() if k >= least)
    of_page = {i: s & set(usable) for i, s in sets.items()}
    tried = {frozenset(c) for i, s in of_page.items() if bad[i] for k in range(1, len(s) + 1) for c in itertools.combinations(sorted(s), k)}
    for c in tried:
        have = [i for i, s in of_page.items() if c <= s]
        hit = sum(bad[i] for i in have)
        if hit >= least and hit / len(have) >= url_filter.MIN_CONFIDENCE and hit / len(have) > n_bad / n:
            found[tuple(sorted(c))] = (hit / len(have), hit / n)
    kept = {c: v for c, v in found.items() if not any(set(o) < set(c) and found[o][0] >= v[0] for o in found)}
    assert rules.keys() == kept.keys() and rules and all(
        abs(rules[c][0] - kept[c][0]) < 1e-9 and abs(rules[c][1] - kept[c][1]) < 1e-9 for c in kept)
    out = url_filter.url_filter(pages, url_filter.mine(pages, labels, min_pages=least)).collect()
    for x in out:
        if x["rule"] is None:
            assert x["verdict"] == ("block" if any(set(c) <= sets[x["page_id"]] for c in kept) else "allow")
    assert any(x["rule"] is None and x["verdict"] == "block" for x in out)


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    h = [xxhash.xxh64_intdigest(" ".join(w[j:j + 3]).encode(), 42) for j in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def contaminated(text, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w = word.findall((text or "").translate(LOWER))
    hit = set()
    for item in items:
        v = word.findall((item or "").translate(LOWER))
        k = min(13, len(v))
        for j in range(len(v) - k + 1 if k else 0):
            for i in range(len(w) - k + 1):
                if w[i:i + k] == v[j:j + k]:
                    hit.update(range(i, i + k))
    return bool(hit) and 20 * len(hit) >= len(w)


def restated(rows, items, model):
    from tokenizers import Tokenizer

    left = [r for r in rows if not nearest(r[1], model)[2]]
    by_text = {}
    for r in left:
        key = (r[1] or "").translate(LOWER)
        if key not in by_text or by_text[key][0] < r[0]:
            by_text[key] = r
    left = list(by_text.values())
    fp = {r[0]: fingerprint(r[1]) for r in left}
    root = {i: i for i in fp}
    for _ in fp:
        for i, j in itertools.permutations(fp, 2):
            if (fp[i] ^ fp[j]).bit_count() <= 3 and root[j] < root[i]:
                root[i] = root[j]
        if all(root[root[i]] == root[i] for i in fp):
            break
    left = [r for r in left if root[r[0]] == r[0] and not contaminated(r[1], items)]
    t = Tokenizer.from_file(packing.public_tokenizer_path())
    out = Counter()
    for r in left:
        ids, at = t.encode(r[1] or "", add_special_tokens=False).ids + [0], 0
        for k in packing.piece_lengths(len(ids)):
            out[r[0], at, k, tuple(ids[at:at + k])] += 1
            at += k
    return out


def corpus():
    r = random.Random(8)
    words = {"en": ["the", "and", "thing", "other", "over", "with"], "fr": ["élan", "que", "les", "eaux", "où", "dans"]}
    say = lambda k, n: " ".join(r.choice(words[k]) + (r.choice("abcdefghij") * r.randrange(2)) for _ in range(n))
    rows = [(i, say(k, r.randrange(12, 60)), k) for i in range(120) for k in [["en", "fr"][i % 2]]]
    rows += [(200 + i, rows[i][1], "en") for i in range(6)] + [(210 + i, rows[i][1].upper(), "en") for i in range(3)]
    long = say("en", 400).split()
    rows += [(220 + i, " ".join([*long[:100 * i], "zz", *long[100 * i:]]), "en") for i in range(1, 4)]
    item = say("en", 30)
    rows += [(230, item, "en"), (231, say("en", 20) + " " + item, "en"), (240, None, "en"), (241, "", "fr"), (242, "12 34 !!", None), (243, "the " * 3000, None)]
    return [(i, t, k, "s", len(t or "")) for i, t, k in rows], [item, None, "", say("fr", 5)]


def write(spark, path, rows, items):
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([Row(item_id=i, text=t) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


@pytest.mark.parametrize("with_items", [True, False])
def test_pipeline(spark, tmp_path, with_items):
    import corpus_pipeline

    rows, items = corpus()
    items = items if with_items else []
    write(spark, tmp_path, rows, items)
    got = Counter((p["doc_id"], p["start"], p["length"], tuple(p["input_ids"])) for p in corpus_pipeline.run(spark, str(tmp_path)).collect())
    model = language.fit(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    want = restated(rows, items, model)
    assert got == want
    kept = {k[0] for k in want}
    assert (230 in kept) == (not with_items) and 240 not in kept and 243 in kept


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    write(spark, tmp_path, [], ["one two three"])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and "input_ids" in out.columns


def test_packing_looks_units_up_once_for_megabytes_of_text():
    import pyarrow as pa

    from estatelens.llm import packing
    from estatelens.llm.bytesops import chunks

    table = pa.table({"doc_id": list(range(300)), "text": ["ten bytes " * 1000] * 300})
    assert [rows.num_rows for rows, _, _ in chunks(iter(table.to_batches()), limit=packing.TEXT)] == [300]
