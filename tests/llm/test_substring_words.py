"""Windows that only share a hash are not repeats."""

import pytest

from estatelens.llm import substring_dedup


def collisions():
    """Two words that a polynomial hash modulo 2**64 cannot tell apart."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("apart", [1, 700])
def test_words_are_compared(spark, apart):
    one, other = collisions()
    shared = [f"word{i}" for i in range(34)]
    fill = [f"x{i} " * 800 for i in range(apart - 1)]  # other chunks between
    texts = [" ".join([*shared, one]), *fill, " ".join([*shared, other])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1 if apart == 1 else 4)
    removed = {r["doc_id"]: r["n_removed"] for r in substring_dedup.substring_dedup(docs.where(f"doc_id in (0, {len(texts) - 1})")).collect()}
    assert set(removed.values()) == {0}
    both = {r["doc_id"]: r["n_removed"] for r in substring_dedup.substring_dedup(docs).collect()}
    assert both[0] == both[len(texts) - 1] == 0
    equal = spark.createDataFrame([(0, " ".join([*shared, one, "p"])), (1, " ".join(["q", *shared, one]))], "doc_id long, text string")
    assert {r["n_removed"] for r in substring_dedup.substring_dedup(equal).collect()} == {35}


def test_extension_compares_the_new_word():
    import numpy as np

    text = b"a b c d e f a b c d e g"
    w = substring_dedup.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert w.same(np.array([0, 1, 2]), np.array([6, 7, 8]), 3)
    assert not w.same(np.array([0, 1, 2, 3]), np.array([6, 7, 8, 9]), 3)
    assert not w.same(np.array([3]), np.array([9]), 3) and w.same(np.array([], int), np.array([], int), 3)
