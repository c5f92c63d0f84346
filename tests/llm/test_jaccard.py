import random
import re
from itertools import combinations

import pytest

from lexmill.llm import jaccard


def shingled(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingled(t) for _, t in rows]
    distinct = [s for s in dict.fromkeys(sets) if s]
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    links = dict.fromkeys(distinct, 0)
    for a, b in combinations(distinct, 2):
        if len(a & b) >= 0.8 * len(a | b):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    members = {}
    for (i, _), s in zip(rows, sets):
        if s:
            members.setdefault(find(s), []).append(i)
    low = {k: min((i for i in v if i is not None), default=None) for k, v in members.items()}
    return sorted(((i, low[find(s)], links[s], sets.count(s)) if s else (i, i, 0, 1) for (i, _), s in zip(rows, sets)), key=repr)


def check(documents, rows):
    got = jaccard.jaccard_join(documents(rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in got), key=repr) == brute(rows)
    return got


@pytest.mark.parametrize("block", [2048, 7])
def test_matches_brute_force(documents, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard, "COLUMNS", 64)
    rng, rows = random.Random(6), []
    for g in range(6):
        base = [f"w{rng.randrange(10_000)}" for _ in range(rng.randrange(60, 150))]
        for _ in range(12 if g else 30):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10_000)}"
            rows.append((len(rows), " ".join(copy)))
    check(documents, rows)


def test_odd_texts_and_first_of_each(documents, odd_texts):
    rows = [r for r in odd_texts if r[0] != 7] + [(20, "one two three four"), (None, "one")]
    got = check(documents, rows)
    docs = documents(rows)
    kept = jaccard.first_of_each(docs, jaccard.jaccard_join(docs))
    assert kept.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    assert (5, "one two three four") in kept and (20, "one two three four") not in kept
    assert (4, "one") in kept and (None, "one") not in kept
    assert kept.count((8, "twice the same row")) == 1
    assert {(1, None), (2, ""), (3, " \t\n\v\f\r ")} <= set(kept)
    assert len(got) == len(rows)
    assert jaccard.jaccard_join(documents([])).collect() == []


def test_prefix_is_shortened_to_the_target():
    depth = jaccard.prefix_depth(0.8, 32, 10, 0.9999)
    assert 1 - (1 - 0.8 ** depth) ** 32 >= 0.9999 > 1 - (1 - 0.8 ** (depth + 1)) ** 32
    assert jaccard.prefix_depth(0.99, 32, 10, 0.9) == 10
