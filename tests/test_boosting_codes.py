"""Slots of a coded column are counted at once."""

import numpy as np

from labelworks.plans.boosting import Growth, _Booster, _coded


def test_slots_without_common_rows_share_a_code():
    hot = np.array([[1, 0, 0, 0], [0, 1, 0, 0], [1, 0, 1, 0], [0, 0, 0, 1]])
    codes = [(code.tolist(), among.tolist()) for code, among in _coded(hot)]
    assert codes == [([1, 2, 0, 3], [0, 1, 3]), ([1, 0, 1, 0], [2])]


def test_sums_are_those_of_each_slot():
    rng = np.random.default_rng(1)
    x = np.concatenate([np.eye(4)[rng.integers(0, 4, 90)], rng.integers(0, 2, (90, 2)), rng.random((90, 1))], axis=1)
    weight, target = rng.random(90), rng.normal(size=90)
    booster = _Booster(x, rng.integers(0, 2, 90).astype(float), weight, np.ones(90, bool), Growth(1, 0.1, 3, 1, 8, 1.0, 1.0, 1))
    rows, slot = np.arange(0, 90, 2), np.arange(45) % 3
    _, cells = booster._sums(slot, rows, target, 3, True)
    for i, w in enumerate((np.ones(90), weight, weight * target)):
        for j in range(6):
            want = [[w[rows[(slot == k) & (x[rows, j] == v)]].sum() for v in (0, 1)] for k in range(3)]
            np.testing.assert_allclose(cells[1][i, j], want, atol=1e-12)
    assert len(booster.coded) <= 3
