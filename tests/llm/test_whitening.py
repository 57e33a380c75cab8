import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from relaymart.llm import whitening as w

SCHEMA = "vec_id long, embedding array<double>, label int"
SHAPES = {
    "isotropic": lambda r: r.normal(size=(400, 24)),
    "low rank": lambda r: r.normal(size=(300, 4)) @ r.normal(size=(4, 10)),
    "repeated": lambda r: np.repeat(r.integers(0, 3, size=(40, 6)).astype(float), 9, axis=0),
    "scaled": lambda r: r.normal(size=(300, 8)) * 10.0 ** np.arange(-4, 4),
    "constant": lambda r: np.ones((50, 4)),
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("rows", [1, 7, 1024])
def test_rank_one_updates_give_the_scatter(shape, rows):
    x = SHAPES[shape](np.random.default_rng(1))
    parts = []
    for part in np.array_split(x, 3):
        s = w.Spectrum.none(x.shape[1])
        for i in range(0, len(part), rows):
            s.add(part[i:i + rows])
        parts.append(s)
    whole = parts[0]
    for other in parts[1:]:
        whole.merge(other)
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    size = max(np.abs(scatter).max(), 1e-9)
    assert whole.n == len(x)
    np.testing.assert_allclose(whole.mean, x.mean(axis=0), rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose((whole.vectors * whole.values) @ whole.vectors.T, scatter, atol=1e-12 * size)
    np.testing.assert_allclose(whole.vectors.T @ whole.vectors, np.eye(x.shape[1]), atol=1e-12)
    np.testing.assert_allclose(whole.values, np.linalg.eigvalsh(scatter), atol=1e-12 * size)


def test_secular_roots_interlace():
    r = np.random.default_rng(2)
    for _ in range(200):
        d = np.sort(r.normal(size=12) * 10.0 ** r.integers(-6, 6, size=12))
        z = r.normal(size=12) * 10.0 ** r.integers(-3, 3, size=12)
        origin, tau = w.secular_roots(d, z)
        new = d[origin] + tau
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(z, z))
        assert (new >= d).all() and (new[:-1] <= d[1:]).all()
        np.testing.assert_allclose(new, want, atol=1e-13 * np.abs(want).max())


def check(rows, out, components=16):
    """The contract, by numpy and Python integers."""
    x = {}
    for i, (vec_id, v, _) in enumerate(rows):
        if v and all(c is not None and math.isfinite(c) for c in v):
            x[i] = [math.floor(64 * c) + 1_000_000 for c in v]
    distinct = sorted({tuple(v) for v in x.values()})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[float(n * c - s) / n for c, s in zip(v, sums)] for v in distinct])
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    k = min(components, int((e > 1e-12 * np.trace(cov)).sum()))
    assert len(out) == k * len(x)
    by_id = {}
    for r in out:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    of_id = {rows[i][0]: v for i, v in x.items()}
    assert by_id.keys() == (of_id.keys() if k else set())
    for vec_id, found in by_id.items():
        v = of_id[vec_id]
        assert sorted(found) == list(range(1, k + 1))
        for c, same in found.items():
            for r in same:
                assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(v, sums))
                assert abs(r.explained - e[-c] / e.sum()) <= 1e-10 * r.explained and r.identity_error < 1e-9
                mine = (np.array([(n * a - s) / n for a, s in zip(v, sums)]) @ q[:, -c]) / math.sqrt(e[-c])
                assert abs(abs(r.whitened) - abs(mine)) < 1e-7
    if k:  # one sign for all rows
        for c in range(1, k + 1):
            signs = {np.sign(found[c][0].whitened * ((np.array(of_id[i]) - np.array(sums) / n) @ q[:, -c]))
                     for i, found in by_id.items() if abs(found[c][0].whitened) > 1e-6}
            assert len(signs) == 1


def test_report_against_brute_force(spark, corpus):
    r = np.random.default_rng(3)
    base = r.normal(size=(300, 20)) * np.linspace(0.2, 1.5, 20)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[i % 3][1], None) for i in range(40)]  # repeated vectors count once
    rows += [(2000, None, 1), (2001, [], 1), (2002, [math.nan] * 20, 1), (2003, [1.0] * 19 + [math.inf], 1),
             (2004, [1.0] * 19 + [None], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit(1)).withColumn("n", F.lit(2)).repartition(7)
    check(rows, w.report(df).collect())


def test_other_lengths_null_ids_and_huge_entries(spark, corpus):
    r = np.random.default_rng(4)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(r.normal(size=(60, 3)))]
    odd = [(None, [0.5, 0.25, 1.0], 0), (70, [1.0] * 5, 0), (71, [1e300] * 3, 0)]
    out = w.report(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    assert {r.vec_id for r in out} == {None, *range(60)} and {r.n for r in out} == {61}
    huge = [(i, (v * 1e9).tolist(), 0) for i, v in enumerate(r.normal(size=(60, 3)))]
    assert all(r.deviation is None for r in w.report(spark.createDataFrame(huge, SCHEMA)).collect() if r.component == 1)


def test_nothing_to_spread(spark, corpus):
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(9)]):
        assert w.report(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_spectra_combine_in_levels(spark, corpus):
    x = np.random.default_rng(5).integers(-90, 90, size=(500, 6))
    df = spark.createDataFrame([((v + w.SHIFT).tolist(),) for v in x], "x array<long>").repartition(9)
    found, sums = w.spectrum_of(df, 6, rows=16, fan=2)
    centred = x - x.mean(axis=0)
    np.testing.assert_allclose((found.vectors * found.values) @ found.vectors.T, centred.T @ centred, atol=1e-6)
    assert sums.tolist() == (x + w.SHIFT).sum(axis=0).tolist()
