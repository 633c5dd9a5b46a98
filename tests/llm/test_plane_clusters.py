"""Bit-plane k-means against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from epiloom.llm import plane_clusters as pc


def brute(rows, k=8, rounds=10, scale=1024):
    """(vec_id, cluster, distance, cluster inertia, inertia, digest) with Python integers."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    centroids = [v for _, v in order[:k]]

    def assigned():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        groups = {}
        for (c, _), (_, v) in zip(assigned(), kept):
            groups.setdefault(c, []).append(v)
        centroids = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else old for c, old in enumerate(centroids)]
    last = assigned()
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = [sum(d for c, d in last if c == i) for i in range(len(centroids))]
    return [(i, c, d, inertia[c], sum(inertia), name[c]) for (i, _), (c, d) in zip(kept, last)]


@pytest.mark.parametrize("low, high", [(-1, 2), (-8, 8), (-1000, 3), (-(1 << 27), 1 << 27)])
def test_planes_are_exact(low, high):
    rng = np.random.default_rng(1)
    values = rng.integers(low, high, (50, 64))
    values[0], values[1] = low, high - 1
    planes = 1 + max((v if v >= 0 else ~v).bit_length() for v in (low, high - 1))
    words = pc.pack(values, planes)
    assert (pc.unpack(words) == values).all()
    for other in values[:9]:
        assert (pc.dots(words, pc.pack(other[None, :], planes)[0]) == values @ other).all()
    cluster, distance = pc.nearest(words, (values**2).sum(1), values[:5])
    far = ((values[:, None, :] - values[None, :5, :]) ** 2).sum(2)
    assert (cluster == far.argmin(1)).all() and (distance == far.min(1)).all()


def vectors():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(5, 64))
    rows = [(i, [float(x) for x in (centres[i % 5] + rng.normal(scale=0.4, size=64)).astype(np.float32)]) for i in range(150)]
    rows += [(200 + i, [0.25] * 64) for i in range(60)]  # a third are copies
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, rows[9][1])]
    bad = [(900, None), (901, []), (902, [1.0] * 63), (903, [None] + [1.0] * 63), (904, [float("nan")] + [1.0] * 63), (905, [float("-inf")] + [1.0] * 63)]
    return rows + bad


SCHEMA = "vec_id long, embedding array<float>, cluster string, label int"


@pytest.mark.parametrize("parts", [1, 5])
def test_clusters_against_brute_force(spark, parts):
    rows = vectors()
    frame = spark.createDataFrame([(*r, "mine", None) for r in rows], SCHEMA).repartition(parts)
    out = pc.clusters(frame, keep=["vec_id"])
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, brute(rows)))


def test_few_equal_or_no_vectors(spark):
    few = [(i, [float(i)] * 64) for i in range(3)] + [(i, [1.5] * 64) for i in (7, 8)]
    out = pc.clusters(spark.createDataFrame([(*r, None, None) for r in few], SCHEMA), keep=[])
    assert sorted(map(tuple, out.collect())) == sorted(brute(few))
    equal = [(i, [-0.3] * 64) for i in range(20)]  # ties: all in the first cluster, the others stay empty
    found = pc.clusters(spark.createDataFrame([(*r, None, None) for r in equal], SCHEMA)).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in found} == {(0, 0, 0)}
    assert pc.clusters(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_that_no_long_distance_holds(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        pc.clusters(frame)
