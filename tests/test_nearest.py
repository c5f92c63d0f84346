import numpy as np
import pandas as pd

from lexmill.operators import graph as G


def test_scores_are_held_in_bounded_pieces(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = rng.integers(-2, 3, (300, 4)).astype(float) + 0.25  # many equal vectors: ties
    rows = pd.DataFrame({"segment_id": np.arange(300), "embedding": vectors.tolist()})
    segments = spark.createDataFrame(rows).repartition(2)
    queries = segments.selectExpr("segment_id AS query_id", "embedding AS vector")
    got = sorted((r.query_id, -round(r.similarity, 9), r.segment_id) for r in G.nearest(segments, queries, 3).collect())
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    # equal vectors have equal scores whatever piece they are in
    want = sorted(t for i in range(300) for t in sorted((i, -round(float(x), 9), j) for j, x in enumerate(unit @ unit[i]))[:3])
    assert [(q, s) for q, s, _ in got] == [(q, s) for q, s, _ in want]

    sizes = []
    monkeypatch.setattr(G, "MAX_SCORES", 4_000)
    frame = rows.copy()
    real = G._best
    monkeypatch.setattr(G, "_best", lambda scores, names, k: sizes.append(scores.size) or real(scores, names, k))
    local = []

    class Frames:  # the function that tasks run, taken from the plan of a frame that only records it
        columns = ["segment_id", "embedding"]
        schema = segments.schema

        def select(self, *_):
            return self

        def mapInPandas(self, f, schema):
            local.append(f)
            return spark.createDataFrame([], schema)

    G.nearest(Frames(), queries, 3).collect()
    found = pd.concat(local[0](iter([frame.iloc[:120], frame.iloc[120:]])))
    assert max(sizes) <= 4_000 and len(found) == 900
    assert sorted((q, -round(s, 9)) for q, s in zip(found.query_id, found.similarity)) == [(q, s) for q, s, _ in want]
