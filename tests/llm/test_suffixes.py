import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import suffixes


def brute(rows, window):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + window] for b in data for i in range(len(b) - window + 1))
    out = []
    for (i, _), b in zip(rows, data):
        gone = np.zeros(len(b) + 2, bool)
        for s in range(len(b) - window + 1):
            if seen[b[s:s + window]] > 1:
                gone[s + 1:s + 1 + window] = True
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), bytes(x for x, g in zip(b, gone[1:]) if not g)))
    return sorted(out, key=repr)


def check(documents, rows, window, anchor):
    got = suffixes.dedup_bytes(documents(rows), window, anchor).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=repr) == brute(rows, window)


def test_matches_brute_force(documents, monkeypatch):
    monkeypatch.setattr(suffixes, "TASK_BYTES", 2000)
    monkeypatch.setattr(suffixes, "TARGET_BYTES", 4000)
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("abé") for _ in range(rng.randrange(200)))) for i in range(30)]
    base = "".join(rng.choice("abcdefgh") for _ in range(300))
    for i in range(30, 60):
        at = rng.randrange(300)
        rows.append((i, base[:at] + str(i) + base[at + 1:]))
    check(documents, rows, 24, 8)


def test_odd_texts(documents, odd_texts):
    check(documents, [r for r in odd_texts if r[0] != 7], 400, 32)
    check(documents, [], 400, 32)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=8), max_size=6))
def test_merge_is_sorted_with_true_prefixes(groups):
    readers = []
    for group in groups:
        common, rests = suffixes.front_code(sorted(group))
        readers.append(suffixes.Run(common.tolist(), rests))
    merged = list(suffixes.merge_runs(readers))
    texts = [m[2] for m in merged]
    assert texts == sorted(x for g in groups for x in g)
    for before, (_, _, text, common) in zip(texts, merged[1:]):
        n = 0
        while n < min(len(before), len(text)) and before[n] == text[n]:
            n += 1
        assert common == n


@given(st.binary(max_size=200), st.binary(max_size=200), st.binary(max_size=100))
def test_shared_prefix(head, a, b):
    x, y = head + a, head + b
    n = 0
    while n < min(len(x), len(y)) and x[n] == y[n]:
        n += 1
    assert suffixes.shared(x, y, 0) == n == suffixes.shared(x, y, len(head))


def test_common_anchor_and_first_window_are_split(documents, monkeypatch):
    """A passage that many documents hold between texts of their own: no anchor and no first window has it all."""
    made, merged = suffixes._runs, suffixes._merged

    def runs(window, targets):
        inner = made(window, targets)

        def run(key, frame):
            sizes = frame.drop_duplicates(["anchor", "content"]).groupby("anchor")[frame.columns[-1]].agg(lambda x: sum(map(len, x)))
            assert sizes.max() <= 1000, sizes.max()
            return inner(key, frame)

        return run

    def merge(window):
        inner = merged(window)

        def run(key, frame):
            prefix = Counter()
            for row in frame.itertuples():
                stop = np.cumsum(np.frombuffer(row.sizes, np.int64)).tolist()
                reader = suffixes.Run(np.frombuffer(row.common, np.int64).tolist(), [row.rests[a:b] for a, b in zip([0, *stop[:-1]], stop)])
                while reader.text is not None:
                    prefix[reader.text[:window]] += len(reader.text)
                    reader.step()
            assert max(prefix.values()) <= 1000, prefix.most_common(1)
            return inner(key, frame)

        return run

    monkeypatch.setattr(suffixes, "TASK_BYTES", 1000)
    monkeypatch.setattr(suffixes, "_runs", runs)
    monkeypatch.setattr(suffixes, "_merged", merge)
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    passage, tails = noise(60), [noise(3) for _ in range(4)]
    rows = [(i, noise(50) + passage + tails[i % 4] * (i % 3 > 0) + noise(50)) for i in range(120)]
    rows += [(200 + i, noise(20) + passage[10:30] + noise(20)) for i in range(80)]  # less than a window
    check(documents, rows + [(500, rows[0][1]), (500, rows[0][1])], 24, 8)
