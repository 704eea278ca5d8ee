"""Centroid clustering against distances in full with Python's integers."""

import hashlib
import math
import random

import pytest

from sparktide.llm import bisector


def plain(rows, dim, k, rounds, seed=3, scale=1_024):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in v):
            kept.append((i, [math.floor(x * scale) for x in v]))

    def digest(i):
        return hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()

    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def far(v, c):
        return sum((a - b) ** 2 for a, b in zip(v, c, strict=True))

    def nearest(v):
        return min(range(len(centroids)), key=lambda j: (far(v, centroids[j]), j))

    for _ in range(rounds):
        best = [nearest(v) for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), b in zip(kept, best, strict=True) if b == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    best = [nearest(v) for _, v in kept]
    most, d = 2**63 - 1, [min(2**63 - 1, far(v, centroids[b])) for (_, v), b in zip(kept, best, strict=True)]
    inertia = {j: min(most, sum(x for x, b in zip(d, best, strict=True) if b == j)) for j in set(best)}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    found = [(i, b, x, inertia[b], min(most, sum(d)), sha[b]) for (i, _), b, x in zip(kept, best, d, strict=True)]
    return sorted(found, key=str)


def found(spark, rows, dim, k, rounds):
    frame = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, v int")
    return sorted([tuple(r) for r in bisector.cluster(frame, dim=dim, k=k, rounds=rounds)[0].collect()], key=str)


def _rows(n, dim, spread, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, spread) for _ in range(dim)]) for i in range(n)]
    # Ties: points on a small grid, repeated rows and equal ids.
    rows += [(1_000 + i, [rng.randint(-1, 1) / 1024 for _ in range(dim)]) for i in range(n)]
    rows += rows[:20] + [(3, [0.5] * dim), (None, [0.25] * dim), (None, None)]
    return rows + [(-1, None), (-2, [None] * dim), (-3, [float("nan")] * dim), (-4, [float("inf")] * dim), (-5, [1.0] * (dim + 1)), (-6, [])]


@pytest.mark.parametrize("dim,k,spread", [(3, 8, 0.01), (64, 8, 1.0), (3, 40, 0.002), (2, 8, 1e17), (2, 5, 1e200)])
def test_clusters_are_those_of_all_distances(spark, dim, k, spread):
    rows = _rows(60, dim, spread, dim + k)
    assert found(spark, rows, dim, k, 4) == plain(rows, dim, k, 4)


def test_fewer_vectors_than_centroids(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None)]
    assert found(spark, rows, 2, 8, 3) == plain(rows, 2, 8, 3)
    assert found(spark, [], 2, 8, 3) == []
    with pytest.raises(ValueError):
        bisector.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>"), scale=1_000)


def test_sums_beyond_a_long_come_back_from_limbs():
    rng = random.Random(2)
    for value in [0, -1, 2**32, -(2**32), 2**95, -(2**95) + 1, *(rng.randint(-(2**90), 2**90) for _ in range(50))]:
        for n in (3, 4, 6):
            limbs = bisector._limbs(value, n)
            assert sum(x << (32 * k) for k, x in enumerate(limbs)) == value
            assert all(0 <= x < 2**32 for x in limbs[:-1])
