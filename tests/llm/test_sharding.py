"""The communication matrix: its law by enumeration, and its margins and spread at any size."""

from collections import Counter
from itertools import product
from math import comb, factorial, prod

import numpy as np
import pytest

from tessera.llm.op3_sharding import communication_matrix, hypergeometric


@pytest.mark.parametrize("rows, capacity", [([3, 2, 2], [3, 4]), ([2, 3], [2, 2, 1]), ([1, 1, 1, 1], [2, 2])])
def test_law_of_small_matrices(rows, capacity):
    """Chi-squared of many draws against the law that enumeration gives."""

    def tables(i, left):
        if i == len(rows):
            yield ()
            return
        for row in product(*[range(c + 1) for c in left]):
            if sum(row) == rows[i]:
                for rest in tables(i + 1, [c - x for c, x in zip(left, row)]):
                    yield (row, *rest)

    ways = prod(map(factorial, rows)) * prod(map(factorial, capacity)) / factorial(sum(rows))
    law = {t: ways / prod(factorial(x) for row in t for x in row) for t in tables(0, capacity)}
    assert sum(law.values()) == pytest.approx(1)
    n = 6000
    got = Counter(tuple(map(tuple, communication_matrix(np.array(rows), np.array(capacity), seed).tolist())) for seed in range(n))
    assert set(got) <= set(law)
    chi = sum((got[t] - n * p) ** 2 / (n * p) for t, p in law.items())
    assert chi < len(law) + 5 * (2 * len(law)) ** 0.5


@pytest.mark.parametrize("good, bad, n", [(5, 7, 6), (1, 50, 3), (300, 20, 200), (40, 40, 79), (1000, 9000, 500)])
def test_law_of_one_draw(good, bad, n):
    many = 200_000
    x = hypergeometric(np.random.default_rng(1), *(np.full(many, v) for v in (good, bad, n)))
    seen = Counter(x.tolist())
    law = {k: comb(good, k) * comb(bad, n - k) / comb(good + bad, n) for k in range(max(0, n - bad), min(good, n) + 1)}
    common = {k: p for k, p in law.items() if p * many >= 20}
    assert set(seen) <= set(law)
    assert sum((seen[k] - many * p) ** 2 / (many * p) for k, p in common.items()) < len(common) + 5 * (2 * len(common)) ** 0.5


@pytest.mark.parametrize("total", [10**6, 10**10, 10**13])
def test_margins_and_spread_of_large_ones(total):
    rows = np.full(64, total // 64)
    capacity = np.full(40, total // 40) + (np.arange(40) < total // 64 * 64 - total // 40 * 40)
    capacity[-1] += rows.sum() - capacity.sum()
    got = communication_matrix(rows, capacity, 3)
    assert (got.sum(1) == rows).all() and (got.sum(0) == capacity).all() and (got >= 0).all()
    mean = total / 64 / 40
    spread = (mean * (1 - 1 / 40) * (1 - 1 / 64)) ** 0.5
    assert ((got - mean) ** 2).mean() ** 0.5 == pytest.approx(spread, rel=0.06)
    # the values lie apart from each other, and not on a rounded grid
    assert len(np.unique(got % 97)) == 97


def test_no_rows():
    assert communication_matrix(np.array([0]), np.array([0, 0]), 1).tolist() == [[0, 0]]
    assert communication_matrix(np.array([5]), np.array([2, 3]), 1).tolist() == [[2, 3]]
