import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import hard_negatives as H


def brute(rows, anchor, pos=5, neg=5, low=80, high=100, scale=256):
    ok = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(scale * x) for x in v]
        if sum(x * x for x in w) <= 2 ** 62:
            ok[i, label] = min(ok.get((i, label), w), w)
    out = []
    for a in sorted({i for i, _ in ok if anchor(i)}):
        label = min(b for i, b in ok if i == a)
        va = ok[a, label]
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, b) for (i, b), v in ok.items() if i != a and len(v) == len(va))
        for s, p, _ in [t for t in scored if t[2] == label][:pos]:
            fits = [t for t in scored if t[2] != label and low * -s <= 100 * -t[0] <= high * -s]
            out += [(a, p, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(fits[:neg])]
    return sorted(out)


def found(spark, rows, anchor="vec_id % 10 = 0", **more):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("id", "v", "grp", "salt", "goal", "score", "rank", "anchor", "bytes")})
    return sorted(tuple(r) for r in H.mine(df, F.expr(anchor), **more).collect())


@pytest.mark.parametrize("shard", [4 << 20, 3000])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(H, "SHARD_BYTES", shard)
    monkeypatch.setattr(H, "BLOCK_BYTES", 700)
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 4)), (rng.integers(-6, 7, 5) / 64).tolist()) for i in range(260)]  # ties
    rows += [(300 + i, i % 2, [0.1, 0.2, -0.1, 0.3, 0.0]) for i in range(60)]  # copies under two labels
    rows += [(400 + i, i % 3, [0.0] * 5) for i in range(25)]
    rows += [(500, None, [1.0] * 5), (510, 1, None), (520, 1, [1.0, None, 0.0, 0.0, 0.0]), (530, 1, [float("nan")] * 5), (540, 1, [float("inf")] * 5), (None, 1, [1.0] * 5)]
    rows += [(550, 1, [1e30, 0.0, 0.0, 0.0, 0.0]), (560, 1, []), (561, 1, []), (562, 2, []), (570, 1, [0.5, 0.5]), (571, 1, [0.5, 0.25]), (572, 2, [0.5, 0.3])]
    rows += [(20, 1, [0.1] * 5), (20, 1, [0.1] * 5), (20, 3, [0.2] * 5), (600, 1, [1e6] * 5), (601, 1, [1e6] * 5), (602, 2, [9e5] * 5), (603, 2, [-1e6] * 5)]
    assert found(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_products_beyond_exact_floats(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, (rng.integers(-(1 << 28), 1 << 28, 4) / 256.0).tolist()) for i in range(80)]
    got = found(spark, rows, window=(10, 100))
    assert got == brute(rows, lambda i: i % 10 == 0, low=10) and max(r[4] for r in got) > 2 ** 53


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(5)
    points = np.unique(np.concatenate([rng.normal(c, 3, (200, 8)) for c in rng.normal(0, 60, (10, 8))]).round().astype(np.int64), axis=0)
    tree = H.CoverTree(points)

    def below(node):
        return [int(c) for c in node.centres[1:]] + [p for d in node.below if d for p in below(d)]

    def check(node):
        for c, reach, deeper in zip(node.centres, node.reach, node.below):
            if deeper:
                assert (tree.distances(np.array(below(deeper)), np.array([c])) <= reach + tree.blur).all()
                check(deeper)

    check(tree.root)
    assert sorted([0, *below(tree.root)]) == list(range(len(points)))
    asked = points[::50]
    exact = asked @ points.T
    low, high = (exact.max(axis=1) * 8) // 10, exact.max(axis=1)
    d = H.Descent(tree, asked, 4, low, high)
    for q in range(len(asked)):
        want = sorted((-s, p) for p, s in enumerate(exact[q].tolist()) if low[q] <= s <= high[q])[:4]
        assert [(-s, p) for s, p in zip(d.score[q].tolist(), d.point[q].tolist()) if p >= 0] == want
    assert d.compared < 0.6 * exact.size


def test_nothing_to_mine(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, 1, [1.0]), (2, 1, [1.0]), (3, 2, [1.0])]) == []
    assert found(spark, [(10, 1, [1.0]), (3, 2, [1.0])]) == []
    assert found(spark, [(10, 1, [1.0]), (2, 1, [-1.0]), (3, 2, [-1.0])]) == []
    assert found(spark, [(10, 1, [1.0]), (2, 1, [0.0]), (3, 2, [0.0])]) == [(10, 2, 1, 3, 0, 0)]
