import hashlib
import math

import numpy as np
import pytest

from arterial.llm import kmeans

HEAD = "vec_id bigint, embedding array<float>, label int, cluster string, group string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, "clash", None) for i, v in rows], HEAD)


def brute_force(rows, k, rounds, size, scale):
    """Sorted (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)."""
    kept = [(i, [min(max(math.floor(scale * float(np.float32(x))), -(1 << 25)), 1 << 25) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    ordered = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in ordered[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for c, (_, v) in zip(of, kept) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [nearest(v) for _, v in kept]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    by = [sum(d for d, c in last if c == j) for j in range(len(centroids))]
    return sorted(((i, c, d, by[c], sum(by), digest[c]) for (i, _), (d, c) in zip(kept, last)), key=repr)


def found(df, **options):
    got = kmeans.cluster_vectors(df, **options).collect()
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got), key=repr)


@pytest.mark.parametrize("columns", [2, 5, 64])
def test_odd_rows_match_brute_force(spark, columns):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(60)] + [(100 + i, [0.25] * 5) for i in range(30)]
    rows += [
        (200, None), (201, []), (202, [1.0] * 4), (203, [1.0, None, 1.0, 1.0, 1.0]), (204, [float("nan")] * 5), (205, [float("-inf")] * 5),
        (7, [1.0] * 5), (7, [1.0] * 5), (None, [2.0] * 5), (206, [1e30, 0.0, 0.0, 0.0, -1e30]),
    ]
    options = {"k": 6, "rounds": 3, "size": 5, "scale": 64}
    assert found(frame(spark, rows), columns=columns, **options) == brute_force(rows, **options)


def test_few_vectors_copies_and_empty(spark):
    options = {"k": 16, "rounds": 2, "size": 3, "scale": 64}
    for rows in ([(1, [0.1, 0.2, 0.3])], [(i, [0.5, 0.5, 0.5]) for i in range(40)], [(1, None), (2, [1.0])]):
        assert found(frame(spark, rows), **options) == brute_force(rows, **options)
    assert found(frame(spark, []), **options) == []


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "GROUP_ROWS", 7)
    monkeypatch.setattr(kmeans, "GROUPS_PER_SALT", 3)
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(150)]
    options = {"k": 5, "rounds": 2, "size": 4, "scale": 64}
    assert found(frame(spark, rows).repartition(4), columns=3, **options) == brute_force(rows, **options)
