import random
from collections import Counter

import numpy as np

from lexmill.llm import lines

BLANK = " \t\n\v\f\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, min_chars):
    split = [(t or "").split("\n") for _, t in rows]
    key = lambda x: x.strip(BLANK).translate(LOW)
    seen = Counter(k for ls in split for k in {key(x) for x in ls} if len(k) >= min_chars)
    out = []
    for (i, _), ls in zip(rows, split):
        kept = [x for x in ls if seen[key(x)] < min_docs]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def check(documents, rows, min_docs, min_chars):
    got = lines.dedup_lines(documents(rows), min_docs, min_chars).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got), key=repr) == brute(rows, min_docs, min_chars)


def test_matches_brute_force(documents, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 5)
    rng = random.Random(2)
    pool = [*"abcdefgh", "", " ", "É x", "Long line of text", "\tLONG line of text \r", "漢"]
    rows = [(i % 50, "\n".join(rng.choice(pool) for _ in range(rng.randrange(8)))) for i in range(80)]
    check(documents, rows, 5, 1)
    check(documents, rows, 20, 2)


def test_odd_texts(documents, odd_texts):
    check(documents, odd_texts, 2, 1)
    check(documents, [], 10, 1)


def test_hash_is_minimal_perfect_and_rejects_others():
    rng = np.random.default_rng(0)
    h1, h2 = (rng.integers(0, 1 << 63, 20_000).astype(np.uint64) for _ in range(2))
    levels, slot = lines.build_hash(h1[:10_000], h2[:10_000])
    assert sorted(slot.tolist()) == list(range(10_000))
    assert (lines.find_slots(levels, h1[:10_000], h2[:10_000]) == slot).all()
    shard = lines.Shard(b"".join(lines.pack_shard(h1[:10_000], h2[:10_000], np.arange(10_000) + 1)))
    assert (shard.count(h1[:10_000], h2[:10_000]) == np.arange(10_000) + 1).all()
    assert not shard.count(h1[10_000:], h2[10_000:]).any()
    empty, none = lines.build_hash(h1[:0], h2[:0])
    assert empty == [] and (lines.find_slots(empty, h1[:3], h2[:3]) == -1).all()
