"""The exact join searches a query's own cell first, and then few others."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelworks.operators import neighbours as D
from tests.test_neighbours import table


def brute(q, t, k, p):
    d = np.abs(q[:, None] - t[None]) ** p
    d = np.round(d.sum(axis=2) ** (1 / p), 12)
    order = np.lexsort((np.broadcast_to(np.arange(len(t)), d.shape), d), axis=1)[:, :k]
    return sorted((i, int(j), round(float(d[i, j]), 6), place) for i, row in enumerate(order) for place, j in enumerate(row, 1))


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("block", [40, 4096])
def test_the_same_neighbours_as_by_all_pairs(spark, monkeypatch, p, block):
    """Repeated rows, ties, cells of several blocks, one cell with fewer rows than are asked for, queries far from all."""
    monkeypatch.setattr(D, "BLOCK_ROWS", block)
    monkeypatch.setattr(D, "PIVOTS", 8)
    rng = np.random.default_rng(3)
    t = np.concatenate([np.round(rng.normal(size=(200, 3)), 1), np.full((60, 3), 0.5), np.round(rng.normal(size=(20, 3)) + 9, 1), [[50.0, 0, 0]]])
    q = np.concatenate([t[::7], np.round(rng.normal(size=(20, 3)), 1), [[49.0, 0, 0], [-500.0, 3, 3]]])
    got = D.neighbour_join(table(spark, q, "q"), table(spark, t, "t"), "q", "t", "v", 6, p)
    assert sorted(map(tuple, got.select("q", "t", "distance", "place").collect())) == brute(q, t, 6, p)


def test_few_cells_are_asked(spark, monkeypatch):
    kept, keep = [], D.keep
    monkeypatch.setattr(D, "keep", lambda df: kept.append(keep(df)) or kept[-1])
    rng = np.random.default_rng(5)
    # four numbers that matter beside ten of which one is 1, as in encoded rows
    t, q = (np.concatenate([rng.random((n, 2)), np.eye(10)[rng.integers(0, 10, n)]], axis=1) for n in (3000, 200))
    assert D.neighbour_join(table(spark, q, "q"), table(spark, t, "t"), "q", "t", "v", 5).count() == 1000
    asked = kept[-1].select(F.explode("_b.cells").alias("_cells")).agg(F.sum(F.size("_cells"))).first()[0] or 0
    assert asked / 200 < 8, asked


def test_repeated_and_missing_query_keys(spark):
    train = table(spark, np.arange(12.0).reshape(6, 2), "t")
    asked = spark.createDataFrame([(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [4.0, 5.0])], "q long, v array<double>")
    got = [(r.q, r.t, r.place) for r in D.neighbour_join(asked, train, "q", "t", "v", 2).orderBy("q", "place").collect()]
    assert got == [(None, 2, 1), (None, 1, 2), (1, 0, 1), (1, 0, 2)]


def test_missing_numbers_and_too_few_rows(spark):
    nan = float("nan")
    train = table(spark, np.array([[0.0, 1.0], [5.0, 5.0]]), "t")
    asked = spark.createDataFrame([(1, [0.0, 1.0]), (2, [nan, 1.0]), (3, [float("inf"), 0.0])], "q long, v array<double>")
    got = D.neighbour_join(asked, train, "q", "t", "v", 3)
    assert sorted((r.q, r.t, r.place) for r in got.where("q = 1").collect()) == [(1, 0, 1), (1, 1, 2)]
