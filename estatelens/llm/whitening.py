"""Whitening of embeddings on their leading principal components.

Entries become integers, so the fit list (each different vector once), its
number and its sums are exact.  Tasks add up the centred products of their
rows; the matrix that goes through the driver has one entry for a pair of
dimensions.  Its components come from :mod:`estatelens.llm.feast`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm import feast
from estatelens.llm.shared import cut

COMPONENTS = 16
STEP = 64
OFFSET = 1_000_000
#: Integers stay within this, so that they are exact as doubles.
LARGEST = float(1 << 52)
_ROWS = 4096


@dataclass
class Whitening:
    """``n`` fit vectors with integer ``sums``; ``axes`` has a component in
    each column, ``values`` their eigenvalues; ``explained`` their shares."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n x - S as integers, and x - S/n."""
        if len(x) and max(int(np.abs(x).max()), int(np.abs(self.sums.astype(float)).max()) // self.n + 1) * self.n >= 1 << 62:
            exact = x.astype(object) * self.n - self.sums.astype(object)
        else:
            exact = x * self.n - self.sums.astype(np.int64)
        return exact, exact.astype(float) / self.n

    def apply(self, y: np.ndarray) -> np.ndarray:
        return y @ (self.axes / np.sqrt(self.values))


def integers(vector: Column) -> Column:
    """floor(64 c) + 1000000 of every entry; beyond 2**52 it stays there."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * STEP, F.lit(LARGEST)), F.lit(-LARGEST))) + OFFSET)


def _usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False)) & (F.size(vector) > 0)


def _matrices(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            flat = pc.list_flatten(part.column(part.schema.get_field_index(name))).to_numpy()
            yield part, flat.reshape(part.num_rows, -1)


def _summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of ``of`` (a matrix of rows to ``size`` numbers):
    added up in each task, then by place."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches, "x"):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total.astype(float))], names=["place", "value"])

    out = np.zeros(size)
    for r in rows.mapInArrow(task, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toLocalIterator():
        out[r["place"]] = r["value"]
    return out


def _integer_sums(rows: DataFrame, size: int) -> np.ndarray:
    """Exact sums by dimension: high and low halves apart, so that doubles
    hold them, as long as there are fewer than 2**27 rows a task."""
    def halves(x: np.ndarray) -> np.ndarray:
        high = x >> 26
        return np.concatenate([high.sum(axis=0), (x - (high << 26)).sum(axis=0)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches, "x"):
            total = halves(x) if total is None else total + halves(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * size)), pa.array(total)], names=["place", "value"])

    both = np.zeros(2 * size, object)
    found = rows.mapInArrow(task, "place long, value long").groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    for r in found.toLocalIterator():
        both[r["place"]] = int(r["value"])
    return both[:size] * (1 << 26) + both[size:]


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``embeddings`` whose vector has entries, all of them finite, and the
    most frequent length (of equally frequent ones the largest), plus ``x``,
    the vector in integers."""
    rows = embeddings.where(_usable(F.col(f"`{vector}`")))
    common = rows.groupBy(F.size(f"`{vector}`").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    size = common["size"] if common else 0
    return rows.where(F.size(f"`{vector}`") == size).withColumn("x", integers(F.col(f"`{vector}`")))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Learn from the different ``x`` of ``rows``.  Components whose
    eigenvalue is at rounding level (constant or dependent dimensions, few
    vectors) do not exist."""
    distinct = cut(rows.select("x").distinct())
    n = distinct.count()
    if not n:
        return Whitening(0, np.zeros(0, object), np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    d = len(distinct.first()["x"])
    model = Whitening(n, _integer_sums(distinct, d), np.zeros(0), np.zeros((d, 0)), np.zeros(0))

    def products(x: np.ndarray) -> np.ndarray:
        y = model.centred(x)[1]
        return (y.T @ y).ravel()

    v = _summed(distinct, products, d * d).reshape(d, d) / n
    v = (v + v.T) / 2
    values, axes = feast.leading(v, components)
    trace = float(np.trace(v))
    model = Whitening(n, model.sums, values, axes, values / trace if trace else values)
    if len(values):
        whole = model

        def white(x: np.ndarray) -> np.ndarray:
            z = whole.apply(whole.centred(x)[1])
            return (z.T @ z).ravel()

        k = len(values)
        identity = _summed(distinct, white, k * k).reshape(k, k) / n
        model.identity_error = float(np.abs(identity - np.eye(k)).max())
    return model


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for every usable row and component: vec_id, component, n,
    deviation, whitened, explained and identity_error.

    Rows are dropped if the vector is null, empty, holds null or non-finite
    entries, or has another length than most.  Repeated vectors count once in
    the fit and all get rows; null ids pass through.  There are fewer
    components than asked if the vectors span fewer dimensions, so none for
    an empty table or for copies of one vector.  A deviation that does not
    fit a long is null.  Columns other than the two named are not read."""
    narrow = embeddings.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector}`").alias("embedding"))
    rows = usable(narrow).select("vec_id", "x")
    held = rows.sparkSession.sparkContext.broadcast(fit(rows, components))
    kind = narrow.schema["vec_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Whitening = held.value
        k = len(m.values)
        if not k:
            return
        for part, x in _matrices(batches, "x"):
            exact, y = m.centred(x)
            if exact.dtype != object and int(np.abs(exact).max()) ** 2 * exact.shape[1] >= 1 << 63:
                exact = exact.astype(object)
            total = (exact * exact).sum(axis=1)
            if exact.dtype == object:
                deviation = pa.array([t if t < 1 << 63 else None for t in total.tolist()], pa.int64())
            else:
                deviation = pa.array(total)
            row = pa.array(np.repeat(np.arange(len(x)), k))
            size = len(x) * k
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(size, m.n)),
                deviation.take(row), pa.array(m.apply(y).ravel()), pa.array(np.tile(m.explained, len(x))),
                pa.array(np.full(size, m.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(task, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
