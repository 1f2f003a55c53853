"""Whitening against exact sums and a dense eigenvalue solver."""

from fractions import Fraction
import math

import numpy as np
import pytest

from estatelens.llm import feast, whitening
from estatelens.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, N string, Component int"


def brute(rows):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, tuple(math.floor(64 * float(c)) + 1000000 for c in v)) for i, v in kept]
    fit = sorted({t for _, t in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(t, sums)] for t in fit])
    values, axes = np.linalg.eigh(y.T @ y / n)
    return x, n, sums, values[::-1], axes[:, ::-1], y


def check(out, rows, components=16):
    x, n, sums, values, axes, y = brute(rows)
    assert len(out) == len(x) * components
    by = {}
    for r in out:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    trace = values.sum()
    signs = {}
    for i, t in x:
        centred = np.array([float(Fraction(n * c - s, n)) for c, s in zip(t, sums)])
        for k in range(1, components + 1):
            r = by[i, k][0]
            assert r["n"] == n and r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(t, sums))
            assert abs(r["explained"] - values[k - 1] / trace) < 1e-10
            assert r["identity_error"] < 1e-9
            want = centred @ axes[:, k - 1] / math.sqrt(values[k - 1])
            if abs(want) > 1e-6:
                sign = signs.setdefault(k, np.sign(want * r["whitened"]))
                assert abs(sign * r["whitened"] - want) < 1e-7 * max(1, abs(want))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(op11_whitening(spark, sf).collect(), rows)


def test_odd_rows(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(c) for c in draw.standard_normal(20).astype(np.float32)]) for i in range(60)]
    rows += [(100, rows[0][1]), (0, rows[0][1]), (101, None), (102, [None] * 20), (103, [float("nan")] * 20), (104, [float("inf")] * 20), (105, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in [*rows, (106, [1.0, 2.0])]], SCHEMA).repartition(4)
    out = whitening.whiten(df).collect()
    assert sum(r["vec_id"] == 0 for r in out) == 32
    check([r for r in out], rows)
    assert {r["vec_id"] for r in out}.isdisjoint(range(101, 107))


def test_few_dimensions(spark):
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    out = whitening.whiten(spark.createDataFrame(line, "vec_id long, embedding array<double>")).collect()
    assert len(out) == 9 and {r["component"] for r in out} == {1} and abs(out[0]["explained"] - 1) < 1e-12
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(same.where("vec_id < 0")).count() == 0
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1.0]), (3, [-1e300, 3.0])], "vec_id long, embedding array<double>")
    got = whitening.whiten(huge).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3} and all(r["deviation"] is None for r in got if r["vec_id"] != 2)


@pytest.mark.parametrize("kind", ["plain", "steep", "equal", "zero"])
def test_feast(kind):
    draw = np.random.default_rng(2)
    for n in (1, 2, 17, 40, 90):
        q, _ = np.linalg.qr(draw.standard_normal((n, n)))
        e = np.sort(draw.random(n))[::-1]
        e = {"plain": e, "steep": e ** 8, "equal": np.repeat(e[::4], 4)[:n], "zero": np.where(np.arange(n) < n // 2 + 1, e, 0)}[kind]
        a = (q * e) @ q.T
        a = (a + a.T) / 2
        want = np.linalg.eigvalsh(a)[::-1]
        for shift in draw.random(5):
            assert feast.count_above(a, shift) == (want > shift).sum()
        values, vectors = feast.leading(a, 16)
        k = len(values)
        assert k == min(16, (want > feast.np.abs(a).sum(axis=1).max() * n * 1e-15).sum())
        assert np.abs(values - want[:k]).max() < 1e-13 and np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-8
        assert np.abs(a @ vectors - vectors * values).max() < 1e-13
    assert len(feast.leading(np.zeros((3, 3)), 16)[0]) == 0
