import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in sorted({(i, t) for i, t in items if i is not None and t is not None}):
        asked, scored = Counter(terms(text)), []
        for i, b in bags:
            m = 100 - 75 + 75 * sum(b.values()) * n_docs // total
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 8 * m)) for t, c in asked.items() if t in b)
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def found(spark, documents, docs, items, k=10):
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("block", F.lit("x"))
    return sorted((tuple(r) for r in lexical.search(documents(docs), asked, k).collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 40)))) for i in range(n)]


@pytest.mark.parametrize("leaf, entries, block", [(64, 2_000_000, 2 << 20), (2, 900, 150)])
def test_equals_brute_force(spark, documents, odd_texts, monkeypatch, leaf, entries, block):
    for name, value in (("LEAF", leaf), ("TREE_ENTRIES", entries), ("BLOCK_BYTES", block)):
        monkeypatch.setattr(lexical, name, value)
    docs = corpus(1, 500) + [(1000 + i, "W0 w1, the SAME words w0") for i in range(150)] + odd_texts
    items = [(i, t) for i, t in corpus(2, 25)] + [(50, "w0 w0 w0 w1"), (51, "w119"), (52, "unseen"), (53, None), (54, ""), (None, "w1"), (55, "größe é 漢字"), (56, "w3"), (56, "w4"), (57, "w5"), (57, "w5")]
    items += [(58, "twice the same row"), (59, "alpha1 beta2 gamma3"), (60, "id"), (61, "xx x" * 2000)]
    assert found(spark, documents, docs, items) == brute(docs, items)


def test_walk_leaves_out_what_cannot_win(monkeypatch):
    monkeypatch.setattr(lexical, "LEAF", 4)
    docs, items = corpus(3, 4000), corpus(4, 10)
    docs += [(5000 + i, t + " " + t) for i, (_, t) in enumerate(items) for _ in range(10)]
    own = lexical.Items.of(np.arange(10), np.arange(10), lexical.pa.array([t for _, t in items]))
    code = {t.decode(): c for c, t in enumerate(own.terms.to_pylist())}
    bags = [Counter(t for t in terms(d) if t in code) for _, d in docs]
    df = Counter(t for b in bags for t in b)
    race = lexical.Race(own, np.array([lexical.weight(len(docs), df[t]) for t in code]), 10)
    rows = [sorted((race.rank[code[t]], n) for t, n in b.items()) for b in bags]
    first = np.cumsum([0, *map(len, rows)])
    flat = np.array([x for r in rows for x in r], np.int64)
    total = sum(len(terms(d)) for _, d in docs)
    m = np.array([25 + 75 * len(terms(d)) * len(docs) // total for _, d in docs])
    race.walk(lexical.FPTree(np.array([i for i, _ in docs]), m, first, flat[:, 0], flat[:, 1]))
    got = sorted((i, r + 1, int(d), int(s)) for i in range(10) for r, (d, s) in enumerate(zip(race.doc[i], race.score[i])) if s > 0)
    assert got == sorted(brute(docs, items))
    assert race.scored < 0.5 * len(docs) * len(items)


def test_nothing_to_rank(spark, documents):
    assert found(spark, documents, [], [(1, "a b")]) == []
    assert found(spark, documents, [(1, "a b")], []) == []
    assert found(spark, documents, [(1, None), (2, " .,")], [(1, "a b")]) == []
    assert found(spark, documents, [(1, "a b")], [(1, "c"), (2, "...")]) == []
