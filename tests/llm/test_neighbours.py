import math

import numpy as np
import pytest

from lexmill.llm import neighbours


def brute(rows, asked, k):
    ok = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        ok[i] = min(ok.get(i, v), v)
    out = []
    for q in sorted({i for i in asked if i in ok}):
        near = sorted((math.dist(ok[q], v), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))[:k]
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return out


def found(spark, rows, k, factor):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.where("vec_id % 10 = 0"), k, factor).orderBy("query_id", "rank").collect()
    return [(r.query_id, r.rank, r.vec_id, r.score) for r in got]


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_exact_search_matches_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(300)]  # many ties and equal vectors
    rows += [(400 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(60)]
    rows += [(500, None), (510, []), (520, [0.0] * 4), (530, [1.0, None, 2.0, 3.0]), (540, [float("nan"), 1.0, 1.0, 1.0]), (550, [float("inf"), 1.0, 0.0, 0.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    rows += [(600, [1.0, 2.0]), (601, [1.0, 3.0]), (610, [5.0, 2.0]), (20, [0.5, 0.5, 0.5, 0.5]), (20, [0.5, 0.5, 0.5, 0.5])]
    want = brute(rows, {i for i, _ in rows if i is not None and i % 10 == 0}, 5)
    got = found(spark, rows, 5, 1.0)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


def test_relaxed_search_keeps_recall_and_prunes():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 0.2, (300, 8)) for c in rng.normal(0, 2, (12, 8))])
    tree, asked = neighbours.build(points, np.arange(len(points))), points[::40]
    exact, loose = (neighbours.Search(points, asked, 10, f) for f in (1.0, 2.0))
    for s in (exact, loose):
        s.visit(tree, np.arange(len(asked)))
    d = neighbours.distances(asked, points)
    assert (exact.which == np.array([np.lexsort((np.arange(len(points)), r))[:10] for r in d])).all()
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact.which, loose.which)]) >= 0.9
    assert loose.compared <= exact.compared < 0.6 * d.size


def test_no_queries_or_vectors(spark):
    assert found(spark, [(1, [1.0, 2.0])], 3, 1.0) == []
    assert found(spark, [], 3, 1.0) == []
    assert found(spark, [(10, [1.0, 2.0])], 3, 1.0) == []
