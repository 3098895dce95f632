import hashlib
import math
import random

import numpy as np
import pytest

from ledgerloom.llm import heap_kmeans as h
from ledgerloom.llm.base import read


def brute(rows, dims, k, rounds, seed=1, scale=64):
    """Every vector compared with every centroid, in Python's integers."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = [hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    raw = [v for i, v in rows if v is not None and len(v) == dims and all(
        x is not None and math.isfinite(x) for x in v)]
    order = sorted(range(len(kept)), key=lambda j: (name[j], raw[j]))[:k]
    cents = [kept[j][1] for j in order]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        got = assign()
        for c in range(len(cents)):
            own = [v for (_, v), (at, _) in zip(kept, got) if at == c]
            if own:
                cents[c] = [sum(x) // len(own) for x in zip(*own)]
    got = assign()
    total = sum(d for _, d in got)
    sums = [sum(d for c, d in got if c == at) for at in range(len(cents))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(i), c, d, sums[c], total, sha[c]) for (i, _), (c, d) in zip(kept, got))


def result(df):
    return sorted((str(r[0]), *tuple(r)[1:]) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "'x' as cluster", "1 as ids", "2 as data")


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_with_ties_copies_and_odd_vectors(spark, seed):
    rng = random.Random(seed)
    centers = [[rng.uniform(-2, 2) for _ in range(4)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.3) for x in rng.choice(centers)]) for i in range(300)]
    rows += [(i % 7, [0.5, -0.5, rng.choice([0.0, 1.0]), 0.0]) for i in range(150)]  # one hot vector, ids again
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (900, None), (901, [1.0]), (902, [1.0, None, 0.0, 0.0]),
             (903, [float("nan")] * 4), (904, [float("inf")] * 4), (905, [])]
    for k, rounds in ((5, 3), (1, 2)) if seed == 1 else ((12, 6),):
        got = result(h.clusters(table(spark, rows), dims=4, k=k, rounds=rounds, block=64))
        assert got == brute(rows, 4, k, rounds)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [0.1, 0.2]), (2, [0.1, 0.2]), (3, [5.0, 5.0])]
    assert result(h.clusters(table(spark, rows), dims=2, k=16)) == brute(rows, 2, 16, 3)
    assert h.clusters(table(spark, [(1, [1.0])]), dims=2).count() == 0
    assert h.clusters(table(spark, []), dims=2).count() == 0


def test_unexpired_vectors_are_not_compared(spark):
    rng = random.Random(4)
    centers = [[20.0 * i, -15.0 * i, 3.0] for i in range(5)]
    rows = [(i, [x + rng.uniform(-1, 1) for x in centers[i % 5]]) for i in range(2000)]
    _, _, scans = h.fit(table(spark, rows), dims=3, k=5, rounds=5)
    assert scans[0] == 2000 and scans[-1] < 400


def test_keys_stay_safe_and_large_components_are_refused():
    rng = np.random.default_rng(5)
    for _ in range(200):
        v, a = rng.integers(-9, 9, (40, 3)), rng.integers(-9, 9, (4, 3))
        b = a + rng.integers(-2, 3, (4, 3))
        own, gaps = h.nearest(v, a)
        heaps, zero = h.Heaps([[] for _ in range(4)]), np.zeros(4)
        heaps.push(own, np.arange(40), gaps, zero)
        _, out = heaps.expired(h.drift(a, b))
        stay = np.setdiff1d(np.arange(40), out)
        assert (h.nearest(v[stay], b)[0] == own[stay]).all()
        assert (heaps.clusters(40)[stay] == own[stay]).all() if len(stay) else True
    big = np.array([[1 << 26, -(1 << 26)]])
    assert h.distances(big, -big).tolist() == [[2 * (1 << 27) ** 2]]
    with pytest.raises(ValueError):
        h.scaled(np.array([1e9]), 64)


def test_query_over_whole_table(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in read(spark, sf, "embeddings").collect()]
    assert result(h.op12_heap_kmeans(spark, sf)) == brute(rows, 64, 16, 3)
