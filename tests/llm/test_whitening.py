import math
from collections import Counter

import numpy as np
import pytest

from quillstat.llm import whitening
from quillstat.llm.spectrum import count_above, leading_pairs, slices

SCHEMA = "vec_id long, embedding array<float>, label int, x string, _key int, deviation int"


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 0, "x", 1, 2) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors, wanted=16):
    kept = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) + 1_000_000) for i, v in vectors
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:wanted], axes[:, ::-1][:, :wanted]
    out = {}
    for i, x in kept:
        away = x.astype(object) * n - sums
        out[i] = (n, int((away * away).sum()), (away.astype(float) / n) @ axes / np.sqrt(values))
    return out, values / np.trace(centred.T @ centred / n)


def test_rows_match_a_dense_eigensolver(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 20)) * np.linspace(3, 0.5, 20)
    vectors = [(i, v.tolist()) for i, v in enumerate(base)]
    vectors += [(1000 + i, base[7].tolist()) for i in range(200)]  # a third of the rows are one vector
    vectors += [(2000, None), (2001, [1.0] * 19 + [None]), (2002, [math.nan] * 20), (2003, [math.inf] * 20), (2004, []), (2005, [1.0, 2.0])]
    want, shares = brute([v for v in vectors if v[0] != 2005])
    got = whitening.whitened_rows(frame(spark, vectors).repartition(7)).collect()
    assert Counter(r.vec_id for r in got) == {i: 16 for i in want}
    sign = np.ones(16)
    for r in got:
        if r.vec_id == 3:
            sign[r.component - 1] = np.sign(r.whitened * want[3][2][r.component - 1])
    for r in got:
        n, deviation, w = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation) and n == 300
        assert r.whitened == pytest.approx(sign[r.component - 1] * w[r.component - 1], abs=1e-8)
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9


def test_degenerate_tables(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    empty = whitening.whitened_rows(frame(spark, []))
    assert empty.columns == columns and empty.count() == 0
    assert whitening.whitened_rows(frame(spark, [(1, None), (2, [math.nan])])).count() == 0
    same = whitening.whitened_rows(frame(spark, [(None, [0.5, 2.0]), (4, [0.5, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [
        (k, 1, 0, None, 0.0, None) for _ in range(2) for k in (1, 2)]
    flat = whitening.whitened_rows(frame(spark, [(1, [0.0, 1.0, 5.0]), (2, [4.0, 1.0, 5.0])])).collect()
    assert [(r.whitened is None) for r in flat if r.vec_id == 1] == [False, True, True]
    assert abs(flat[0].whitened) == pytest.approx(1) and flat[0].explained == 1.0 and flat[0].deviation == (2 * 64 * 2) ** 2


def test_entries_beyond_64_bits_stay_exact(spark):
    big = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [3e30, 0.0])]
    got = {r.vec_id: r for r in whitening.whitened_rows(frame(spark, big), 1).collect()}
    assert got[1].deviation is None and got[1].n == 3 and math.isfinite(got[3].whitened) and got[3].identity_error < 1e-9
    away = np.array([[2 ** 40, 1]])
    assert whitening.deviations(away) == [None] and whitening.deviations(away // 2 ** 10) == [2 ** 60]


def test_inertia_counts_and_slices():
    rng = np.random.default_rng(1)
    for _ in range(300):
        size = int(rng.integers(1, 12))
        a = rng.integers(-2, 3, size=(size, size)).astype(float)
        a, shift = a + a.T, float(rng.choice([0, 0.5, 1, -0.3]))
        found = np.linalg.eigvalsh(a)
        if np.abs(found - shift).min() > 1e-9:
            assert count_above(a, shift) == (found > shift).sum()
    basis = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    for values in ([5, 5, 5, 3, 3] + [1] * 15, list(range(20, 0, -1)), [1e6, 1e6 - 1e-7] + [1] * 18, [4, 4 + 1e-12] + [0] * 18, [2] * 20):
        matrix = (basis * np.array(values, float)) @ basis.T
        matrix = (matrix + matrix.T) / 2
        e, x = leading_pairs(matrix, 8)
        assert np.allclose(e, sorted(values)[::-1][:8], rtol=1e-12, atol=1e-9)
        assert np.abs(x @ x.T - np.eye(8)).max() < 1e-9
        assert np.abs(x @ matrix - e[:, None] * x).max() < 1e-9 * max(values)
    marks = slices(np.diag([4.0, 3.0, 3.0, 1.0]), 4, 1e-9)
    assert [(first, last) for *_, first, last in marks] == [(1, 1), (2, 3), (4, 4)]
    assert all(low < v <= high for (low, high, *_), v in zip(marks, (4, 3, 1)))
