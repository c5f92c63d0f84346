import numpy as np
import pytest

from lexmill.operators import vectors as V


def brute(rows, asked, k):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in asked:
        if v is None or not any(v):
            continue
        v = np.array(v, float) / np.abs(v).max()
        s = sorted((-round(float(v @ (u / np.abs(u).max())) / np.linalg.norm(v) / np.linalg.norm(u / np.abs(u).max()), 9), i) for i, u in ok.items())[:k]
        out[q] = [(i, -d) for d, i in s]
    return out


def found(spark, rows, asked, k, **more):
    df = spark.createDataFrame(rows, "sid long, embedding array<double>").repartition(3)
    index = V.write_vectors(df, "sid", "embedding", **more)
    queries = spark.createDataFrame(asked, "query_id string, vector array<double>")
    got = {}
    for r in V.search_vectors(index, queries, k).collect():
        got.setdefault(r.query_id, []).append((round(r.similarity, 9), r.id))
    return {q: [(i, s) for s, i in sorted(v, key=lambda x: (-x[0], x[1]))] for q, v in got.items()}, index


@pytest.mark.parametrize("part, cells", [(8192, None), (7, 12), (50, 1)])
def test_equals_brute_force(spark, monkeypatch, part, cells):
    monkeypatch.setattr(V, "PART", part)
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(400)]
    rows += [(500, None), (501, []), (502, [0.0] * 6), (503, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (504, [float("nan")] * 6), (505, [1.0] * 3), (506, [1e200] * 6), (None, [1.0] * 6)]
    asked = [(f"q{i}", rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(20)] + [("none", None), ("zero", [0.0] * 6), ("big", [1e300, 0.0, 0.0, 0.0, 0.0, 0.0])]
    got, _ = found(spark, rows, asked, 5, cells=cells)
    want = brute(rows, asked, 5)
    assert set(got) == set(want)
    for q, v in want.items():
        assert np.allclose([s for _, s in got[q]], [s for _, s in v], atol=1e-8)
    # ids agree but where rounding decides between equal cosines
    assert all(set(i for i, s in got[q] if s > v[-1][1] + 1e-8) == set(i for i, s in v if s > v[-1][1] + 1e-8) for q, v in want.items())


def test_clustered_data_is_mostly_not_read(spark):
    rng = np.random.default_rng(9)
    middles = rng.normal(0, 1, (40, 6))
    rows = [(i, (middles[i % 40] + rng.normal(0, 0.05, 6)).tolist()) for i in range(4000)]
    asked = [(f"q{i}", (middles[i] + rng.normal(0, 0.05, 6)).tolist()) for i in range(3)]
    got, index = found(spark, rows, asked, 5)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in brute(rows, asked, 5).items()}
    touched = {c for step in index.read for c in step}
    n = {r.cell: r.n for r in index.cells.collect()}
    assert sum(n[c] for c in touched) < 0.5 * sum(n.values())


def test_fewer_than_k_and_nothing(spark):
    got, _ = found(spark, [(1, [1.0] * 6), (2, [-1.0] * 6)], [("q", [1.0, 0.0, 0.0, 0.0, 0.0, 0.0])], 5)
    assert [i for i, _ in got["q"]] == [1, 2]
    assert found(spark, [], [("q", [1.0])], 5)[0] == {} and found(spark, [(1, [1.0])], [], 5)[0] == {}
