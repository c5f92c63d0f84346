import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lexmill.llm import near_dups as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n=4):
    w = WORD.findall((text or "").translate(UPPER))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(sets[i]), least.get(top(i)), d == least.get(top(i))) for i, (d, _) in enumerate(rows)), key=str)


def found(documents, rows):
    got = N.near_duplicates(documents(rows)).select("doc_id", "n_shingles", "component_id", "kept")
    return sorted((tuple(r) for r in got.collect()), key=str)


def varied(seed, groups, copies, edits):
    rng, out = random.Random(seed), []
    for g in range(groups):
        base = [rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(rng.randrange(30, 120))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            out.append(" ".join(text))
    rng.shuffle(out)
    return list(enumerate(out, 100))


@pytest.mark.parametrize("sets, size", [(2048, 1 << 20), (4, 500)])
def test_equals_brute_force(documents, odd_texts, monkeypatch, sets, size):
    monkeypatch.setattr(N, "BLOCK_SETS", sets)
    monkeypatch.setattr(N, "BLOCK_SHINGLES", size)
    rows = odd_texts + varied(1, 12, 9, 4) + varied(2, 2, 30, 3) + [(900 + i, "Many Times the same line here") for i in range(40)]
    rows += [(1000 + i, t.upper()) for i, (_, t) in enumerate(varied(1, 12, 9, 4)[:20])]
    assert found(documents, rows) == brute(rows)


def test_links_that_miss_every_hub(documents):
    # a chain: each text shares 80 % with the next one only
    rng = random.Random(7)
    tokens = [f"t{i}" for i in range(400)]
    rows = [(i, " ".join(tokens[10 * i:10 * i + 120])) for i in range(25)]
    rng.shuffle(rows)
    assert found(documents, rows) == brute(rows) and len({r[2] for r in found(documents, rows)}) == 1


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 62, 1000).astype(np.uint64))
    b = np.unique(np.concatenate([a[:900], rng.integers(0, 1 << 62, 100).astype(np.uint64)]))
    s = N.minima([a, b, b])
    agree = (s[0] == s[1]).mean()
    assert abs(agree - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.12 and (s[1] == s[2]).all()
    assert (N.check_bytes(s)[0] == N.check_bytes(s)[1]).mean() >= agree
    labels = N.band_labels(s)
    assert labels.shape == (3, N.BANDS) and (labels[1] == labels[2]).all() and len(np.unique(labels[0])) == N.BANDS
    assert N.common([a], [b])[0, 0] == len(np.intersect1d(a, b))


def test_shingles():
    got = [len(s) for s in N.shingles(pa.array(["a b c d e", "A b", "a B", None, "", "x x x x x x"]), 4)]
    assert got == [2, 1, 1, 0, 0, 1]


def test_empty_table(documents):
    assert found(documents, []) == []
