import random
import re
from collections import Counter

import pytest

from lexmill.llm import automaton

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {j for s in range(len(w) - window + 1) if seen[tuple(w[s:s + window])] > 1 for j in range(s, s + window)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def check(documents, rows, window, anchor):
    got = automaton.dedup_words(documents(rows), window, anchor).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in got), key=repr) == brute(rows, window)


@pytest.mark.parametrize("shard_words", [60_000, 40])
def test_matches_brute_force(documents, monkeypatch, shard_words):
    monkeypatch.setattr(automaton, "SHARD_WORDS", shard_words)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(40)))) for i in range(40)]
    base = [f"w{rng.randrange(500)}" for _ in range(60)]
    for i in range(40, 60):  # near copies, each with one change
        copy = list(base)
        copy[rng.randrange(60)] = f"new{i}"
        rows.append((i, " ".join(copy)))
    check(documents, rows, 6, 3)


def test_odd_texts(documents, odd_texts):
    check(documents, odd_texts, 35, 8)
    check(documents, [], 35, 8)


def test_word_repeated_within_one_document(documents):
    check(documents, [(1, "the same words again " * 30), (2, "x " * 80)], 35, 8)


def test_statistics_count_occurrences():
    s = automaton.SuffixAutomaton([[1, 2, 3, 1, 2], [2, 3, 1]], [1, 2])
    assert s.statistics([1, 2, 3, 1, 9, 2, 3], 3) == ([1, 2, 3, 3, 0, 1, 2], [2 + 2, 2, 1, 3, s.count[0], 4, 3])


def test_common_anchor_is_split(documents, monkeypatch):
    """Notices that many documents hold between words of their own: no group has all the passages of an anchor."""
    made = automaton._match

    def match(window):
        inner = made(window)

        def run(key, frame):
            words = frame.drop_duplicates(["anchor", "content"]).groupby("anchor").n.size().max() * window
            assert words <= 200, words
            return inner(key, frame)

        return run

    monkeypatch.setattr(automaton, "SHARD_WORDS", 200)
    monkeypatch.setattr(automaton, "_match", match)
    rng = random.Random(6)
    noise = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    short, long = noise(10), noise(30)
    rows = [(i, " ".join(noise(12) + (short, long)[i % 2] + [f"t{i % 5}"] * (i % 3) + noise(12))) for i in range(150)]
    check(documents, rows + [(500, rows[1][1]), (500, rows[1][1])], 12, 4)
