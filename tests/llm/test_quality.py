import random

import numpy as np
import pyarrow as pa

from lexmill.llm import quality


def corpus(n, seed):
    rng = random.Random(seed)
    good = lambda: " ".join(rng.choice("river stone cloud meadow winter garden letter window".split()) for _ in range(rng.randrange(5, 300))) + "."
    bad = lambda: " ".join(rng.choice(["BUY!!!", "###", "$$$ now", "click 0000"]) for _ in range(rng.randrange(5, 300)))
    return [(i, good() if i % 4 else bad()) for i in range(n)]


def test_learns_and_scores_everything(spark, documents, odd_texts):
    rows = corpus(240, 1)
    docs = documents(rows + [(None if i is None else i + 1000, t) for i, t in odd_texts])
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i, _ in rows if i % 3] + [(None, 1), (7, None), (5, 9), (8, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).select("doc.doc_id", "score", "predicted", "doc.k1").collect()
    assert len(got) == 240 + len(odd_texts) and {r.k1 for r in got} == {"<k1>"}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 3 == 0]
    assert np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in held]) > 0.95
    again = quality.score(docs, quality.fit(docs, labels)).collect()
    assert sorted(r.score for r in again) == sorted(r.score for r in got)


def test_without_labels(spark, documents):
    docs = documents([(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.score(docs, quality.fit(docs, none)).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert [round(r.score, 6) for r in quality.score(docs, quality.fit(docs, one)).collect()] == [0.666667] * 2
    assert quality.score(documents([]), quality.Model(0.5)).collect() == []


def test_gradient():
    rng = np.random.default_rng(0)
    sizes = [1, 4, 2]
    first = np.concatenate([[0], np.cumsum(sizes)])
    x, y = rng.normal(size=(7, quality.FEATURES)), np.array([0.0, 1.0, 1.0])
    shape = {"W": (quality.FEATURES, quality.HIDDEN), "b": (quality.HIDDEN,), "V": (quality.HIDDEN, quality.GATE), "U": (quality.HIDDEN, quality.GATE), "w": (quality.GATE,), "c": (quality.HIDDEN,), "d": (1,)}
    p = {k: rng.normal(0, 0.2, s) for k, s in shape.items()}

    def loss():
        s = quality._sigmoid(quality.forward(p, x, first)["logit"])
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    g = quality.gradient(p, x, first, y)
    for k, a in p.items():
        i = tuple(rng.integers(0, n) for n in a.shape)
        a[i] += 1e-6
        up = loss()
        a[i] -= 2e-6
        assert abs((up - loss()) / 2e-6 - g[k][i]) < 1e-6
        a[i] += 1e-6


def test_every_passage_counts():
    x, first = quality.encode(pa.array(["w " * 200, None, "", " \n", "é" * 10]))
    assert first.tolist() == [0, 4, 5, 6, 7, 8] and np.isfinite(x).all() and not x[4:7].any()
    a = quality.forward({"W": np.ones((quality.FEATURES, 3)), "b": np.zeros(3), "V": np.ones((3, 2)), "U": np.ones((3, 2)), "w": np.ones(2), "c": np.ones(3), "d": np.zeros(1)}, x, first)["a"]
    assert np.allclose(np.add.reduceat(a, first[:-1]), 1)


def test_features_do_not_depend_on_the_neighbours():
    texts = ["one two.", "Three", "", "four " * 100]
    together, first = quality.encode(pa.array(texts))
    for text, a, b in zip(texts, first[:-1], first[1:]):
        assert (together[a:b] == quality.encode(pa.array([text]))[0]).all()
