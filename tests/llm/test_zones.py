from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pytest

from grantlens.llm import zones
from tests.llm.helpers import SF, clashing


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def plain(rows, k, rounds, seed, scale=256):
    """rows are (vec_id, components): every vector with every centroid."""
    ids = [i for i, _ in rows]
    v = np.array([[math.floor(scale * float(np.float32(x))) for x in e] for _, e in rows], dtype=object)
    order = sorted(range(len(ids)), key=lambda j: (hashlib.sha256(f"{seed}:{ids[j]}".encode()).hexdigest(), list(v[j])))
    c = v[order[:k]].copy()

    def near():
        far = np.array([[((x - y) ** 2).sum() for y in c] for x in v], dtype=object)
        return [min(range(len(c)), key=lambda j: (far[i][j], j)) for i in range(len(v))], far

    for _ in range(rounds):
        at, _ = near()
        for j in set(at):
            mine = v[[i for i in range(len(v)) if at[i] == j]]
            c[j] = [sum(mine[:, d]) // len(mine) for d in range(v.shape[1])]
    at, far = near()
    return sorted((ids[i], at[i], far[i][at[i]]) for i in range(len(ids))), c.tolist()


def got(found):
    return sorted((r.vec_id, r.cluster, r.distance) for r in found.collect())


@pytest.mark.parametrize("dimensions, size", [(2, 4), (3, 16), (64, 8)])
def test_against_all_pairs(spark, dimensions, size):
    rng = np.random.default_rng(dimensions)
    centres = rng.normal(size=(6, dimensions))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=dimensions)).tolist(), 0) for i in range(150)]
    rows += [(1000 + i, [0.5] * dimensions, 0) for i in range(60)]
    found, c = zones.clustered(embeddings(spark, rows), k=9, rounds=3, dimensions=dimensions, size=size)
    want, centroids = plain([r[:2] for r in rows], 9, 3, 2)
    assert got(found) == want and c.tolist() == centroids


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (5, 2)])
def test_neighbours_on_the_curve_are_neighbouring_cells(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = [k.tobytes() for k in zones.hilbert_key(cells, bits)]
    assert len(set(keys)) == len(keys)
    path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_boxes_leave_out_far_centroids_only():
    rng = np.random.default_rng(7)
    left = 0
    for _ in range(50):
        v = rng.integers(-40, 40, size=(20, 3)) + rng.integers(-300, 300, size=3)
        c = rng.integers(-300, 300, size=(12, 3))
        some = zones.candidates(v.min(axis=0), v.max(axis=0), c)
        far = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        assert set(far.argmin(axis=1)) <= set(some)
        assert zones.nearest(v, v.min(axis=0), v.max(axis=0), c)[0].tolist() == far.argmin(axis=1).tolist()
        left += len(some)
    assert left < 50 * 12 / 2


def test_large_components_stay_exact():
    v = np.array([[1 << 27, -(1 << 27)], [(1 << 27) - 1, 5]], dtype=np.int64)
    c = np.array([[-(1 << 27), 1 << 27], [-(1 << 27) + 1, 1 << 27]], dtype=np.int64)
    cluster, far = zones.nearest(v, v.min(axis=0), v.max(axis=0), c)
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c] for x in v]
    assert far.tolist() == [min(w) for w in want] and cluster.tolist() == [w.index(min(w)) for w in want]


def test_what_is_left_out(spark):
    rows = [
        (1, [0.5, 1.0], 0), (2, None, 0), (3, [], 0), (4, [1.0], 0), (5, [1.0, None], 0), (6, [float("nan"), 1.0], 0),
        (7, [float("inf"), 1.0], 0), (8, [1.0, 2.0, 3.0], 0), (9, [-0.001, 0.0], 0), (9, [-0.001, 0.0], 0), (None, [0.25, 0.25], None),
    ]
    found, c = zones.clustered(clashing(embeddings(spark, rows)), k=40, dimensions=2)
    rows = found.collect()
    assert sorted((r.vec_id or 0) for r in rows) == [0, 1, 9, 9] and len(c) == 4
    assert {r.distance for r in rows} == {0}
    # Equal vectors go to the smaller of two equal centroids.
    assert len({r.cluster for r in rows if r.vec_id == 9}) == 1
    assert [-1, 0] in c.tolist()


def test_empty_and_too_large(spark):
    none = embeddings(spark, [(1, [1.0], 0)])
    found, c = zones.clustered(none)
    assert found.count() == 0 and c.shape == (0, 64) and found.columns == ["vec_id", "cluster", "distance"]
    with pytest.raises(Exception, match="too large"):
        zones.clustered(embeddings(spark, [(1, [1e30], 0)]), dimensions=1)


def test_query_sums(spark):
    found = zones.op13_zones(spark, SF).toPandas()
    assert (found.inertia == found.distance.sum()).all()
    assert (found.groupby("cluster").distance.transform("sum") == found.cluster_inertia).all()
    assert len(found) == 500 and found.groupby("cluster").centroid_sha256.nunique().max() == 1
