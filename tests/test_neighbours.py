"""Approximate neighbours and the bounds of the exact ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelworks.operators import hashed_neighbours as A
from labelworks.operators import neighbours as D


def table(spark, points, key):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], f"{key} long, v array<double>").repartition(3)


@pytest.mark.parametrize("p", [1, 2])
def test_all_probes_give_the_exact_join(spark, monkeypatch, p):
    monkeypatch.setattr(A, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(4)
    t = np.round(rng.normal(size=(150, 3)), 1)
    t[:50] = 0.5
    train, asked = table(spark, t, "t"), table(spark, np.round(rng.normal(size=(30, 3)), 1), "q")
    exact = D.neighbour_join(asked, train, "q", "t", "v", 4, p)
    found = A.hashed_neighbour_join(asked, train, "q", "t", "v", 4, p, tables=2, bits=3, probes=8)
    key = lambda df: sorted(map(tuple, df.select("q", "t", "distance", "place").collect()))
    assert key(found) == key(exact)


def test_recall_in_many_dimensions(spark):
    """Clustered vectors need few probes; their number and the tables bound the copies."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 64)) * 3
    t, q = (centres[rng.integers(0, 20, n)] + rng.normal(size=(n, 64)) * 0.3 for n in (900, 60))
    train, asked = table(spark, t, "t"), table(spark, q, "q")
    exact = D.neighbour_join(asked, train, "q", "t", "v", 5)
    found = A.hashed_neighbour_join(asked, train, "q", "t", "v", 5, tables=3, bits=6, probes=4)
    row = A.recall(found, exact, "q", "t").first()
    assert row.n_exact == 300 and row.recall >= 0.9
    placed = A._placed(train.select(F.col("t").alias("_k"), F.col("v").alias("point")), A._planes(64, 3, 6, 1), np.zeros((3, 6)), 4)
    assert placed.groupBy("_k").count().agg(F.max("count")).first()[0] == 12


def test_odd_rows(spark):
    train = spark.createDataFrame([(1, [0.0, 1.0]), (2, None), (None, [1.0, 1.0]), (3, [5.0, 5.0])], "t long, v array<double>")
    asked = spark.createDataFrame([(7, [0.0, 1.0]), (8, None)], "q long, v array<double>")
    got = A.hashed_neighbour_join(asked, train, "q", "t", "v", 3, tables=1, bits=1, probes=2)
    assert [(r.q, r.t, r.place) for r in got.orderBy("place").collect()] == [(7, 1, 1), (7, 3, 2)]
    assert A.hashed_neighbour_join(asked, train.limit(0), "q", "t", "v").count() == 0
    with pytest.raises(ValueError):
        A.hashed_neighbour_join(asked, train, "q", "t", "v", bits=2, probes=5)


def test_bounds_of_many_cells_in_slices(monkeypatch):
    """As many cells as a join may have: the same bounds, a few queries at a time."""
    rng = np.random.default_rng(6)
    to_pivot, reach = rng.random((50, 4096)), np.sort(rng.random((4096, 5)), axis=1)
    want = np.sort((to_pivot[:, :, None] + reach).reshape(50, -1), axis=1)[:, 4]
    held = []
    partition = np.partition
    monkeypatch.setattr(D.np, "partition", lambda a, *r, **k: held.append(a.size) or partition(a, *r, **k))
    np.testing.assert_array_equal(D._kth_bound(to_pivot, reach), want)
    assert max(held) <= D.BOUND_CELLS
