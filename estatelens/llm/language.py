"""Language identification by nearest centroid.

A text is the TF-IDF vector of its hashed 2- and 3-byte grams, scaled to
length one.  Each language has several centroids (spherical k-means), and a
text gets the language of the centroid with the largest cosine.  A text too
far from every centroid is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.llm.bytesops import LOWER, chunks, give_back
from estatelens.llm.shared import replace_columns

FEATURES = 4096
CENTROIDS = 4
ROUNDS = 12
#: Training texts whose vectors are clustered, for each language and in all.
#: Document frequencies come from every training text.
SAMPLE = 1000
SAMPLE_ALL = 8000
#: A cluster with fewer texts is given up, its texts go to the others.
MIN_MEMBERS = 20
#: A text is rejected if its cosine is under this share of the lowest
#: thousandth of its centroid's own training texts, or of those of all its
#: language's if that is less.
REJECT = 0.5
UNKNOWN = "und"
OUT = ("lang_pred", "score", "rejected")

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_FOLD = np.where(_LETTER[LOWER], LOWER, 0x20).astype(np.uint32)
_ROWS = 128


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Gram counts, one row a document; grams stay inside a document."""
    n = len(offsets) - 1
    b = _FOLD[data]
    doc = np.repeat(np.arange(n), np.diff(offsets))
    out = np.zeros(n * FEATURES, np.int32)
    for size in (2, 3):
        if len(b) < size:
            continue
        code = b[:len(b) - size + 1].copy()
        for k in range(1, size):
            code = code << np.uint32(8) | b[k:len(b) - size + 1 + k]
        inside = doc[:len(code)] == doc[size - 1:]
        slot = (code * np.uint32(2654435761) + np.uint32(size * 97)) >> np.uint32(32 - 12)
        out += np.bincount((doc[:len(code)] * FEATURES + slot)[inside], minlength=n * FEATURES).astype(np.int32)
    return out.reshape(n, FEATURES)


def vectors(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts(data, offsets).astype(np.float32)) * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    """``centroids`` are unit vectors; row i speaks ``langs[i]`` and rejects
    cosines under ``least[i]``."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    least: np.ndarray


def held_out(doc_id: Column) -> Column:
    """One document in five, by id: never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _document_frequencies(train: DataFrame) -> np.ndarray:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(FEATURES, np.int64)
        for _, data, offsets in chunks(batches, rows=_ROWS):
            df += (counts(data, offsets) > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES)), pa.array(df)], names=["feature", "n"])

    out = np.zeros(FEATURES)
    summed = train.select("text").mapInArrow(task, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    for r in summed.toLocalIterator():
        out[r["feature"]] = r["n"]
    return out


def _cluster(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from k-means++ starts: centroids, members.

    While a cluster has fewer than ``MIN_MEMBERS`` texts, the smallest is
    given up and the others are moved again."""
    draw = np.random.default_rng(0)
    start = [int(draw.integers(len(x)))]
    far = np.full(len(x), np.inf)
    while len(start) < min(k, len(x)):
        far = np.minimum(far, np.maximum(1 - (x @ x[start[-1]]).astype(np.float64), 0))
        if far.sum() < 1e-3:
            break  # nothing but copies is left
        start.append(int(draw.choice(len(x), p=far / far.sum())))
    c = x[start]
    while True:
        for _ in range(ROUNDS):
            near = np.argmax(x @ c.T, axis=1)
            c = np.stack([x[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        near = np.argmax(x @ c.T, axis=1)
        size = np.bincount(near, minlength=len(c))
        if len(c) == 1 or size.min() >= MIN_MEMBERS:
            return c, near
        c = np.delete(c, int(np.argmin(size)), axis=0)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``text`` and non-null ``lang`` of the rows that are not
    held out.  Rows without a letter teach nothing."""
    text, lang = F.col("`text`"), F.col("`lang`")
    train = docs.select(F.col("`doc_id`").alias("doc_id"), text.alias("text"), lang.cast("string").alias("lang")).where(
        lang.isNotNull() & ~held_out(F.col("doc_id")))
    per_lang = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_lang:
        return Model(np.ones(FEATURES, np.float32), np.zeros((0, FEATURES), np.float32), [], np.zeros(0))
    n = sum(per_lang.values())
    idf = (np.log((1 + n) / (1 + _document_frequencies(train))) + 1).astype(np.float32)
    sample = max(1, min(sample, SAMPLE_ALL // len(per_lang)))
    scale = 1 << 30
    share = F.create_map(*[x for k, v in per_lang.items() for x in (F.lit(k), F.lit(int(scale * min(1.0, sample / v))))])
    drawn = train.where((F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(scale)) < share[F.col("lang")]) & has_letter(F.col("text")))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, rows=_ROWS):
            x = vectors(data, offsets, idf).astype(np.float16)
            yield pa.RecordBatch.from_arrays([rows.column(1), pa.array([v.tobytes() for v in x], pa.binary())], names=["lang", "v"])

    by_lang: dict[str, list[bytes]] = {}
    for r in drawn.select("text", "lang").mapInArrow(task, "lang string, v binary").collect():
        by_lang.setdefault(r["lang"], []).append(bytes(r["v"]))
    centroids, langs, least = [], [], []
    for k in sorted(by_lang):
        x = np.stack([np.frombuffer(v, np.float16) for v in sorted(by_lang[k])]).astype(np.float32)
        c, member = _cluster(x, CENTROIDS)
        near = np.einsum("ij,ij->i", x, c[member])
        lowest = np.quantile(near, 0.001)
        for i in range(len(c)):
            own = near[member == i]
            centroids.append(c[i])
            langs.append(k)
            least.append(REJECT * float(min(lowest, np.quantile(own, 0.001)) if len(own) else lowest))
    stacked = np.stack(centroids) if centroids else np.zeros((0, FEATURES), np.float32)
    return Model(idf, stacked.astype(np.float32), langs, np.array(least))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (cosine, 0 to 1) and rejected.

    Only ``text`` is read.  Null text and text without a letter are ``und``
    with score 0 and rejected; so is everything if nothing was learned.
    Other texts get the nearest language, also when rejected; of equal
    cosines the first language in order wins.  Input columns named like an
    added column are replaced; other columns pass through.
    """
    docs = replace_columns(docs, *OUT)
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    at = [c for c in docs.columns].index("text")
    extra = "__lettered"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = held.value
        for batch in batches:
            names = [f"c{i}" for i in range(batch.num_columns)]
            renamed = pa.RecordBatch.from_arrays(batch.columns, names=names)
            for rows, data, offsets in chunks(iter([renamed]), text=f"c{at}", rows=_ROWS):
                lettered = rows.column(rows.num_columns - 1).to_numpy(zero_copy_only=False)
                if m.langs:
                    cosine = vectors(data, offsets, m.idf) @ m.centroids.T
                    best = np.argmax(cosine, axis=1)
                    score = np.clip(cosine[np.arange(len(best)), best].astype(np.float64), 0, 1)
                    far = score < m.least[best]
                else:
                    best, score, far = np.zeros(len(lettered), int), np.zeros(len(lettered)), ~lettered | True
                lang = [m.langs[b] if ok and m.langs else UNKNOWN for b, ok in zip(best, lettered)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], pa.array(lang, pa.string()), pa.array(np.where(lettered, score, 0.0)), pa.array(far | ~lettered)],
                    names=out.fieldNames())
        give_back()

    out = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                        T.StructField("rejected", T.BooleanType())])
    return docs.withColumn(extra, has_letter(F.col("`text`"))).mapInArrow(task, out)


def identify(docs: DataFrame) -> DataFrame:
    """:func:`predict` with the model learned from the same table."""
    return predict(docs, fit(docs))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows that are not rejected, with the columns of ``docs``."""
    return identify(docs).where("not rejected").select(*[F.col(f"`{c}`") for c in docs.columns])
