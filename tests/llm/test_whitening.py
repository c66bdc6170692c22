"""Whitening against a dense eigensolver and exact sums."""

import math
import random

import numpy as np
import pytest

from labelworks.llm import whitening
from labelworks.llm.queries import QUERIES
from tests.llm.helpers import SF

SCHEMA = "vec_id long, embedding array<double>, x int, at int, n string, whitened double"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "own", 0.5) for r in rows], SCHEMA).repartition(3)


def plain(rows, k=16):
    """(rows that take part, n, deviations, eigenvalues, vectors, trace, centred) by dense algebra."""
    good = [(i, tuple(math.floor(64 * c) + 1000000 for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    longest = max(len(v) for _, v in good)
    good = [r for r in good if len(r[1]) == longest]
    fit = sorted({v for _, v in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    away = lambda v: [n * a - s for a, s in zip(v, sums)]
    centred = np.array([away(v) for v in fit], float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    return good, n, {v: sum(a * a for a in away(v)) for _, v in good}, values[order], vectors[:, order], values.sum(), away


def check(spark, rows, k=16):
    good, n, deviations, values, vectors, trace, away = plain(rows, k)
    got = whitening.whiten(table_of(spark, rows), k).collect()
    assert len(got) == len(good)
    real = values > 1e-12 * max(values[0], 1e-300)
    values, vectors = values[real], vectors[:, real]
    want = {v: (np.array(away(v), float) / n) @ vectors / np.sqrt(values) for _, v in good}
    by_id = {}
    for i, v in good:
        by_id.setdefault(i, []).append(v)
    signs = None
    for r in got:
        v = next(v for v in by_id[r.vec_id] if deviations[v] == r.deviation)
        by_id[r.vec_id].remove(v)
        assert r.n == n and r.identity_error < 1e-9
        assert np.allclose(r.explained, values / trace, rtol=1e-9, atol=0)
        own = np.array(r.whitened)
        if np.abs(want[v]).min(initial=1) > 1e-3 and signs is None:
            signs = np.sign(own * want[v])
        assert np.allclose(np.abs(own), np.abs(want[v]), atol=1e-9)
        assert signs is None or np.allclose(own, signs * want[v], atol=1e-9)


def random_rows(seed, n, dims):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1 + j % 5) for j in range(dims)]) for i in range(n)]


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table.collect()]
    check(spark, rows)
    out = QUERIES["op12_embedding_whitening"](spark, SF)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 16 * len(rows)


def test_odd_rows(spark):
    rows = random_rows(1, 90, 24)
    copies = [(i + 500, rows[3][1]) for i in range(60)] + [(3, rows[3][1]), (None, rows[5][1]), (7, rows[8][1])]
    odd = [(200, None), (201, []), (202, [None] + [0.0] * 23), (203, [math.nan] + [0.0] * 23), (204, [math.inf] + [0.0] * 23), (205, [1.0] * 23)]
    check(spark, rows + copies + odd)
    far = [(i, [x + 1e6 for x in v]) for i, v in rows]
    check(spark, far)


@pytest.mark.parametrize("dims", [1, 3, 16])
def test_few_dimensions_and_rows(spark, dims):
    check(spark, random_rows(dims, 40, dims))
    check(spark, random_rows(dims, 2, dims))


def test_flat_and_alike(spark):
    flat = [(i, [v[0], v[1], v[0] + v[1], 2.0]) for i, v in random_rows(4, 50, 2)]
    flat = [(i, [math.floor(64 * c) / 64 for c in v[:2]]) for i, v in flat]
    check(spark, [(i, [a, b, a + b, 2.0]) for i, (a, b) in flat])
    alike = whitening.whiten(table_of(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0])])).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained) for r in sorted(alike)] == [(1, 1, 0, [], []), (2, 1, 0, [], [])]
    none = table_of(spark, [(1, None), (2, [])])
    assert whitening.whiten(none).count() == 0 == whitening.component_rows(none.limit(0)).count()
    wide = whitening.whiten(table_of(spark, [(1, [2e7, 1.0]), (2, [-2e7, 0.0])])).collect()
    assert {r.deviation for r in wide} == {(2 * int(64 * 2e7)) ** 2 + 64**2}
    assert {r.deviation for r in whitening.whiten(table_of(spark, [(1, [3e7, 1.0]), (2, [-3e7, 0.0])])).collect()} == {None}


@pytest.mark.parametrize(("dims", "kind"), [(200, "flat"), (150, "steep"), (120, "twice")])
def test_eigenpairs(dims, kind):
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    values = {"flat": 1 + np.arange(dims) / 50, "steep": np.exp(-np.arange(dims) / 4.0), "twice": np.repeat(np.arange(dims // 2) + 1.0, 2)}[kind]
    matrix = turn * values @ turn.T
    asked = []
    found = whitening.jacobi_davidson(lambda b: asked.append(b.shape[1]) or matrix @ b, dims, 16)
    assert np.allclose(found.values, np.sort(values)[::-1][:16], rtol=0, atol=1e-12 * values.max())
    assert np.abs(found.vectors.T @ found.vectors - np.eye(16)).max() < 1e-12
    assert np.linalg.norm(matrix @ found.vectors - found.vectors * found.values, axis=0).max() < 1e-12 * values.max()
    assert len(asked) == found.passes <= 160 and max(asked) <= 20


def test_minres_solves_columns_in_step():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    rhs = rng.standard_normal((30, 4))
    rhs[:, 2] = 0
    x = whitening.minres(lambda b: a @ b, rhs, 200, 1e-13)
    assert np.allclose(a @ x, rhs, atol=1e-7)
