import math

import numpy as np
import pytest

from adlake.llm import whitening as W


def covariance(values, rng):
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    return (q * np.array(values)) @ q.T


SPECTRA = {
    "spread": list(np.geomspace(1e3, 1e-9, 40)),
    "even": list(np.linspace(1, 2, 64)),
    "cluster": [5.0] * 3 + [5 - 1e-11] * 2 + [1.0] * 30 + [0.0] * 5,
    "same": [2.0] * 24,
    "rank 3": [9.0, 4.0, 1.0] + [0.0] * 20,
    "one": [3.0],
    "close at the cut": [10 - i for i in range(8)] + [1 + 1e-9 * i for i in range(12)],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_pairs(name):
    v = covariance(SPECTRA[name], np.random.default_rng(3))
    v = (v + v.T) / 2
    values, vectors = W.leading_pairs(v, 16)
    want = np.sort(np.linalg.eigvalsh(v))[::-1]
    rank = int((want > len(v) * W.EPS * np.abs(v).sum(axis=1).max()).sum())
    assert len(values) == min(16, rank)
    np.testing.assert_allclose(values, want[: len(values)], rtol=1e-11, atol=1e-13 * want[0])
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * want[0]


def test_inertia_counts():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 30):
        a = rng.normal(size=(n, n))
        a = a + a.T
        np.fill_diagonal(a, 0)  # needs pivots of two rows
        e = np.linalg.eigvalsh(a)
        for s in [-9.0, 0.1, *(e[:-1] + np.diff(e) / 2)]:
            assert W.eigenvalues_above(a, float(s)) == (e > s).sum()


def test_intervals_hold_few_and_all():
    v = covariance(SPECTRA["spread"], np.random.default_rng(3))
    spans = W.top_intervals(v, 16)
    assert sum(c for _, _, c in spans) >= 16 and all(c <= W.SLICE for _, _, c in spans)


def brute(rows):
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in good}), float)
    n, sums = len(fit), [sum(int(c) for c in col) for col in fit.T]
    centred = fit - fit.mean(0)
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    return good, n, sums, np.array(sums) / n, v, e, q


def test_against_eigh(spark):
    rng = np.random.default_rng(2)
    vs = (rng.normal(size=(300, 24)) * np.geomspace(1, 0.05, 24)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(vs)] + [(1000 + i, vs[0]) for i in range(200)] + [(5, vs[5]), (None, vs[6])]
    rows += [(2000, None), (2001, [None] + [1.0] * 23), (2002, [float("nan")] * 24), (2003, [float("-inf")] + [0.0] * 23), (2004, [])]
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in rows], "vec_id long, embedding array<float>, n int, x string")
    got = W.whiten(df).collect()
    good, n, sums, mean, v, e, q = brute(rows)
    assert len(got) == 16 * len(good) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert 0 <= got[0].identity_error < 1e-10
    want = {}
    for i, x in good:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        w = (np.array(x) - mean) @ q[:, :16] / np.sqrt(e[:16])
        for k in range(16):
            want.setdefault((i, k + 1), []).append((dev, w[k]))
    signs = {}
    for r in got:
        dev, w = want[r.vec_id, r.component].pop()
        assert r.deviation == dev and r.deviation_high == 0
        assert abs(abs(r.whitened) - abs(w)) < 1e-9
        if abs(w) > 1e-3:
            signs.setdefault(r.component, set()).add(r.whitened * w > 0)
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-12
    assert all(len(s) == 1 for s in signs.values())
    assert not any(want.values())


def test_few_vectors_and_lengths(spark):
    kind = "vec_id long, embedding array<double>"
    make = lambda rows: W.whiten(spark.createDataFrame(rows, kind)).collect()
    assert make([]) == [] and make([(1, None)]) == [] and make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    got = make([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [5.0])])
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in sorted(got)] == [(1, 1, 2, 64 * 64), (2, 1, 2, 64 * 64)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and r.explained == pytest.approx(1) for r in got)


def test_sums_beyond_a_long(spark):
    big = [(i, [float(2**44) * (i % 3), 1.0]) for i in range(9)]
    got = W.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()
    sums = [sum(k << 50 for k in range(3)) + 3 * 1000000, 3 * 1000064]
    for r in got:
        dev = (3 * (((r.vec_id % 3) << 50) + 1000000) - sums[0]) ** 2
        assert r.n == 3 and (r.deviation_high << 63) + r.deviation == dev
