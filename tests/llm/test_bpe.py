"""BPE against the tokenizers library."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from estatelens.llm import bpe
from estatelens.llm.packing import public_tokenizer_path

SCHEMA = "doc_id long, text string, Input_Ids string, decoded int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizer_path())


def odd_texts():
    r = random.Random(1)
    letters = "abcdeéß日本 \n\t'sltrevm1234567890.,!?-_  \x1c\x85😀ﬁÅ×÷"
    texts = [None, "", " ", "\n\n ", "a<|endoftext|>b <|endoftext|>  x <|endoftext|>", "<|endoftext|>" * 3, "x" * 5000, "it's we'll I'M  \n\n x y  z",
             "ab" * 300 + " " + "日本語テキスト" * 90, "123 4567,89 ٣٤ ½ ²", "\t\t a", "é" * 200, "the " * 3000, "".join(r.choice("abcd") for _ in range(200_000))]
    return texts + ["".join(r.choice(letters) for _ in range(r.randrange(300))) for _ in range(200)]


def test_encode_and_decode(spark, library):
    rows = [(i, t, "gone", i) for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame([*rows, rows[9], (None, "null id", "", 0)], SCHEMA).repartition(3)
    out = bpe.encode(docs, decoded_col="decoded")
    assert sorted(out.columns) == ["decoded", "doc_id", "input_ids", "text"]
    got = out.collect()
    assert len(got) == len(rows) + 2
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["input_ids"] == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False) == (r["text"] or "")
    again = bpe.decode(out.drop("decoded")).select("doc_id", "decoded")
    assert again.exceptAll(out.select("doc_id", "decoded")).count() == 0
    assert bpe.encode(docs.where("doc_id < 0")).count() == 0


def test_decode_any_ids(spark, library):
    r = random.Random(2)
    rows = [(i, [r.randrange(50257) for _ in range(r.randrange(40))]) for i in range(60)]
    out = bpe.decode(spark.createDataFrame([*rows, (98, None), (99, [None, 60000, 72])], "doc_id long, input_ids array<int>")).collect()
    text = {x["doc_id"]: x["decoded"] for x in out}
    assert text[98] == "" and text[99] == library.decode([72], skip_special_tokens=False)
    for i, ids in rows:  # halves of characters included
        assert text[i] == library.decode(ids, skip_special_tokens=False)


def test_pattern_is_the_library_s(library):
    for c in range(1, 0x500):
        for text in (f"a{chr(c)}b", f"1{chr(c)}2", f" {chr(c)} ", f"!{chr(c)}!", chr(c) * 2):
            want = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
            assert bpe._SPLIT.findall(text) == want


def test_whole_table(spark, library):
    from estatelens.llm.queries import op13_bpe

    out = {r["doc_id"]: r for r in op13_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("t")).collect()
    assert len(out) == len(docs)
    import hashlib
    for d in docs:
        ids = library.encode(d["t"], add_special_tokens=False).ids
        r = out[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(d["t"].encode()).hexdigest()
