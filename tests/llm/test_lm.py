import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import lm

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def toks(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + ["\n"]


def quantised(n, base):
    return float(lm.expected(lm.levels_of(np.array([n]), base), base)[0]) if n else 0.0


def brute(rows, held, order, base=lm.BASE, mu=lm.MU):
    """(base score, score) with exact membership instead of the filter."""
    train = [toks(t) for i, t in rows if not held(i)]
    one = Counter(w for ws in train for w in ws)
    grams = Counter()
    for ws in train:
        padded = ["<"] * (order - 1) + ws
        for n in range(2, order + 1):
            grams.update(tuple(padded[j - n + 1:j + 1]) for j in range(order - 1, len(padded)))
        for n in range(1, order):
            grams[("<",) * n] += 1
    grams.update({(w,): n for w, n in one.items()})
    total = sum(one.values()) + 0.5 * (len(one) + 1)
    out = []
    for i, t in rows:
        ws, plain, full = toks(t), 0.0, 0.0
        padded = ["<"] * (order - 1) + ws
        for j, w in enumerate(ws):
            plain += math.log10((one[w] + 0.5) / total)
            p = (quantised(one[w], base) + 0.5) / total
            for n in range(2, order + 1):
                at = j + order - 1
                h = quantised(grams[tuple(padded[at - n + 1:at])], base)
                p = (min(quantised(grams[tuple(padded[at - n + 1:at + 1])], base), h) + mu * p) / (h + mu)
            full += math.log10(min(p, 1.0))
        out.append((i, len(ws), sum(one[w] > 0 for w in ws), sum(one.values()), plain, full))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_matches_exact_counts(documents, odd_texts, monkeypatch, order):
    monkeypatch.setattr(lm, "SHARD_BYTES", 50_000)
    monkeypatch.setattr(lm, "BITS", 24)
    rows = [r for r in odd_texts if r[0] != 7] + [(100 + i, "the cat sat on the mat and the Dog sat on the cat " * (i % 4)) for i in range(30)]
    got = lm.score_held_out(documents(rows), F.col("doc_id") % 5 == 1, order).collect()
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=repr)
    want = brute(rows, lambda i: i is not None and math.fmod(i, 5) == 1, order)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-12)
    # a false positive of the filter may lift single counts
    assert np.mean(np.isclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)) > 0.9
    assert np.allclose([g[5] for g in got], [w[5] for w in want], atol=0.5)


def test_nothing_to_learn_from_and_empty(documents):
    held = lm.score_held_out(documents([(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score, r.held_out) for r in held) == [(1, 3, 0, 0, 0.0, 0.0, True), (2, 1, 0, 0, 0.0, 0.0, True)]
    assert lm.score_held_out(documents([]), F.lit(False)).collect() == []


def test_filter_never_loses_and_rarely_invents():
    rng = np.random.default_rng(4)
    items, counts = rng.integers(0, 1 << 62, 20_000).astype(np.uint64), rng.integers(1, 50, 20_000)
    bits = lm.build_filter(items, counts, lm.BASE)
    assert (lm.probe(bits, items) >= lm.levels_of(counts, lm.BASE)).all()
    assert (lm.probe(bits, items) > lm.levels_of(counts, lm.BASE)).mean() < 0.05
    assert (lm.probe(bits, rng.integers(0, 1 << 62, 20_000).astype(np.uint64)) > 0).mean() < 0.05


def test_expected_counts_sit_in_their_level():
    n = np.arange(1, 3000)
    level = lm.levels_of(n, 1.5)
    middle = lm.expected(level, 1.5)
    assert (lm.levels_of(np.floor(middle), 1.5) == level).all() and middle[:3].tolist() == [1, 2, 3]
