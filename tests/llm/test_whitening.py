"""Whitening against a dense eigendecomposition, with exact deviations."""

import math

import numpy as np
import pytest

from skeinset.llm import whitening


def plain(rows, components=4):
    """Per row that counts: x; and n, sums, eigenvalues and vectors of the distinct x."""
    kept = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array(sorted({v for _, v in kept}), dtype=float)
    n, sums = len(x), [sum(int(c) for c in col) for col in x.T]
    centred = x - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, sums, values[::-1][:components], vectors[:, ::-1][:, :components], values.sum()


def check(spark, rows, schema="vec_id long, embedding array<double>, n int, x string"):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    got = whitening.whiten(table, ["vec_id"], "embedding").collect()
    kept, n, sums, values, vectors, trace = plain(rows)
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, len(values) + 1)) and all(len(v) == len(kept) for v in by.values())
    mean = np.array([s / n for s in sums])
    want = [(str(i), sum((n * c - s) ** 2 for c, s in zip(x, sums)), *((np.array(x) - mean) @ vectors / np.sqrt(values))) for i, x in kept]
    for c, found in by.items():
        sign = np.sign(sum(r.whitened * w[c + 1] for r, w in zip(sorted(found, key=lambda r: (str(r.vec_id), r.deviation)), sorted(want))))
        mine = sorted((str(r.vec_id), r.deviation, round(r.whitened * sign, 7) + 0.0) for r in found)
        assert [m[:2] for m in mine] == [w[:2] for w in sorted(want)]
        assert np.allclose(sorted(m[2] for m in mine), sorted(w[c + 1] for w in want), atol=1e-6)
        assert all(r.n == n and abs(r.explained - values[c - 1] / trace) < 1e-9 and r.identity_error < 1e-8 for r in found)


@pytest.mark.parametrize("d", [3, 19, 50])
def test_whitening(spark, d):
    rng = np.random.default_rng(d)
    spread = 0.1 + rng.random(d) * np.linspace(3, 0.2, d)
    rows = [(i, (rng.standard_normal(d) * spread).tolist()) for i in range(400)]
    rows += [(1, rows[0][1]), (2, rows[0][1]), (None, rows[5][1]), (900, None), (901, []), (902, [None] * d), (903, [1.0] * (d - 1) + [math.nan])]
    rows += [(904, [math.inf] + [0.0] * (d - 1)), (905, [-0.0] * d), (906, [0.0] * d)]
    check(spark, rows)


def test_flat_spectrum(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(48).astype("f4").astype(float).tolist()) for i in range(3000)]
    check(spark, rows)


def test_repeated_values_are_certified():
    found = whitening.leading_pairs(lambda q: np.diag([5.0] * 30 + [1.0] * 30) @ q, 60, 4)
    assert np.allclose(found[0], 5) and np.allclose(np.linalg.norm(found[1][:30], axis=0), 1)


def test_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(5)], schema)
    got = whitening.whiten(same, ["vec_id"], "embedding").collect()
    assert len(got) == 15 and all(r.whitened is None and r.explained == 0 and r.deviation == 0 and r.n == 1 and r.identity_error == 0 for r in got)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 0.0]) for i in range(4)], schema), ["vec_id"], "embedding").collect()
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True)}
    none = whitening.whiten(same.filter("false"), ["vec_id"], "embedding")
    assert none.count() == 0 and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    with pytest.raises(ValueError, match="number of entries"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema), ["vec_id"], "embedding")


def test_large_numbers_are_exact(spark):
    rows = [(i, [float(i * 7919 % 1000) * 1e5, float(i)]) for i in range(50)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ["vec_id"], "embedding", scale=1.0)
    exact = {i: [math.floor(c) for c in v] for i, v in rows}
    total = [sum(v[j] for v in exact.values()) for j in (0, 1)]
    assert {r.vec_id: r.deviation for r in got.collect()} == {i: sum((50 * c - s) ** 2 for c, s in zip(v, total)) for i, v in exact.items()}
