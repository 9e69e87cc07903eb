import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from arterial.llm import topk

HEAD = "vec_id bigint, embedding array<float>, label int, score string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, "clash", None) for i, v in rows], HEAD)


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [min(max(math.floor(1024 * float(np.float32(x))), -(1 << 25)), 1 << 25) for x in vector]


def brute_force(rows, k, step=100):
    """Sorted (query_id, rank, vec_id, score) over (id, vector) rows."""
    vectors = [(i, w) for i, v in rows if (w := whole(v)) is not None]
    out = []
    for a, (q, x) in enumerate(vectors):
        if q is None or q % step:
            continue
        scored = [(-sum(p * r for p, r in zip(x, y)), i is None, i or 0, i) for b, (i, y) in enumerate(vectors) if a != b]
        out += [(q, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(df, k=10, step=100):
    got = topk.top_k(df, F.col("vec_id") % step == 0, k)
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()), key=repr)


def random_rows(n, size=12, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=size).astype(np.float32) * rng.choice([0.01, 1.0, 5.0])]) for i in range(n)]


def test_odd_rows_match_brute_force(spark):
    odd = [
        (0, None), (100, []), (200, [1.0, None]), (300, [float("nan"), 1.0]), (400, [float("inf")]), (500, [1.0, 2.0]), (1, [1.0, 2.0, 3.0]),
        (500, [1.0, 2.0]), (None, [3.0, -1.0]), (2, [1e30, -1e30]), (600, [0.0, 0.0]), (3, [-0.5]), (700, [2.0, 1.0, -1.0, 0.5]), (4, []),
    ]
    assert found(frame(spark, odd)) == brute_force(odd, 10)
    assert found(frame(spark, odd), 2) == brute_force(odd, 2)
    assert found(frame(spark, []).limit(0)) == []
    assert found(frame(spark, odd[:2])) == []


@pytest.mark.parametrize("parts", [1, 5])
def test_many_blocks_copies_and_ties(spark, monkeypatch, parts):
    monkeypatch.setattr(topk, "BLOCK_COMPONENTS", 1500)
    rows = random_rows(700) + [(1000 + i, [0.5] * 12) for i in range(350)]  # a third of all rows are copies
    assert found(frame(spark, rows).repartition(parts), step=50) == brute_force(rows, 10, 50)


def test_few_vectors_are_scored_exactly():
    """Processing stops on a proof: what is left out stays below the bar, and not everything is scored."""
    vectors = np.array([v for _, v in random_rows(2000, 16, 7)])
    vectors[:, :2] *= 20  # two components carry most of a score
    matrix = np.floor(1024 * vectors).astype(np.int64)

    class Value:
        def __init__(self, value):
            self.value = value

        def as_py(self):
            return self.value

        def as_buffer(self):
            return topk.pa.py_buffer(self.value)

    places = np.argsort(matrix, axis=0, kind="stable").T
    borders = [np.searchsorted(matrix[p, d], [int(matrix[p[0], d]) + (int(matrix[p[-1], d]) - int(matrix[p[0], d]) + 1) * i // topk.LEVELS
                                               for i in range(topk.LEVELS + 1)]) for d, p in enumerate(places)]
    packed = {"matrix": topk.pack(matrix), "places": topk.pack(places), "borders": topk.pack(np.array(borders))}
    block = topk.Block({"size": Value(16), "n": Value(2000), **{k: Value(v) for k, v in packed.items()}})
    scored = []
    exact = block.exact
    block.exact = lambda query, some: scored.append(len(some)) or exact(query, some)
    for i in range(0, 2000, 100):
        full = matrix @ matrix[i]
        full[i] = -(1 << 62)
        near, score, bar = block.best(matrix[i], 10, None, i)
        order = np.lexsort((np.arange(2000), -full))[:10]
        assert list(near) == list(order) and list(score) == list(full[order]) and bar == full[order[-1]]
        again, _, _ = block.best(matrix[i], 10, int(full[order[0]]) + 1, i)
        assert not len(again)
    assert sum(scored) < 20 * 2000
