import random

import numpy as np

from lexmill.llm import decontaminate


def local_score(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + step, h[i - 1, j] - decontaminate.GAP, h[i, j - 1] - decontaminate.GAP)
    return h.max()


def test_alignment_scores():
    rng = np.random.default_rng(3)
    texts, items = rng.integers(2, 6, 400).astype(np.uint64), rng.integers(2, 6, 100).astype(np.uint64)
    where = np.sort(rng.integers(0, 400, (60, 2)), axis=1)
    what = np.sort(rng.integers(0, 100, (60, 2)), axis=1)
    score, _ = decontaminate.align(texts, where, items, what, cells=500)
    assert score.tolist() == [local_score(texts[a:b], items[c:d]) for (a, b), (c, d) in zip(where, what)]


def test_finds_exact_edited_and_split_copies(spark, documents, odd_texts):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    noise = lambda n: [rng.choice(["the", "of", "and", word(), word(), word()]) for _ in range(n)]
    items = {i: noise(40) for i in range(30)}
    rows = [(i, " ".join(noise(300))) for i in range(60)]
    want = {}
    for i in range(30):
        passage = list(items[i])
        if i % 3 == 1:  # edited: a word in eight changed
            for j in range(0, 40, 8):
                passage[j] = word()
        if i % 3 == 2:  # words put in and left out
            del passage[5], passage[20]
            passage.insert(12, "and")
        before = noise(rng.randrange(100))
        rows.append((100 + i, " ".join(before) + " " + " ".join(passage).upper() + ". " + " ".join(noise(50))))
        want[100 + i] = i, len(before), len(before) + len(passage) - 1
    rows += [(1000 + i, " ".join(items[0]) + " " + word()) for i in range(50)]  # a very common leak
    tests = spark.createDataFrame([(i, " ".join(w) + "!") for i, w in items.items()] + [(90, None), (91, ""), (92, "too short"), (None, " ".join(items[3]))], "item_id long, text string")
    got = {}
    for r in decontaminate.find_leaks(documents(rows + [(None if i is None else i + 5000, t) for i, t in odd_texts]), tests).select("doc.doc_id", "doc.k1", "hits").collect():
        assert r.k1 == "<k1>"
        got.setdefault(r.doc_id, []).extend(r.hits)
    for doc, (item, first, last) in want.items():
        hit = next(h for h in got[doc] if h.item_id == item)
        assert abs(hit.first_word - first) <= 2 and abs(hit.last_word - last) <= 2 and hit.score >= 0.55
        assert (hit.score == 1.0) == (item % 3 == 0)
    assert all(got[1000 + i][0].item_id == 0 for i in range(50))
    assert not any(h for d, hs in got.items() for h in hs if d is None or d < 100 or d >= 5000)
    assert {h.item_id for h in got[103]} == {3, None}


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    assert [r.hits for r in decontaminate.find_leaks(documents([(1, "a b c d e f g h")]), none).collect()] == [[]]
    assert decontaminate.find_leaks(documents([]), some).collect() == []
    assert [len(r.hits) for r in decontaminate.find_leaks(documents([(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, None)]), some).collect()] in ([1, 1, 0], [1, 0, 1], [0, 1, 1])


def test_finds_what_the_score_accepts(spark, documents):
    """Copies edited at random, with every third or fourth word replaced, with words between; short items as they are."""
    rng = random.Random(8)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 5000}"  # noqa: E731  some words are in most documents
    noise = lambda n: [word() for _ in range(n)]
    items = {i: noise(15 if i % 2 else 24) for i in range(40)}
    edits = {
        "third": lambda w: [f"x{j}" if j % 3 == 2 else x for j, x in enumerate(w)],
        "fourth": lambda w: [f"x{j}" if j % 4 == 3 else x for j, x in enumerate(w)],
        "between": lambda w: [y for j, x in enumerate(w) for y in (x, f"x{j}")],
        "random": lambda w: [f"x{j}" if rng.random() < 0.3 else x for j, x in enumerate(w)],
    }
    rows, want, ids = [(i, " ".join(noise(200))) for i in range(100)], set(), {}
    for i, text in items.items():
        for edit in edits.values():
            copy = edit(text)
            key = 1000 + len(ids)
            ids[key] = i
            rows.append((key, " ".join(noise(60) + copy + noise(60))))
            score = local_score(np.unique(copy + text, return_inverse=True)[1][:len(copy)], np.unique(copy + text, return_inverse=True)[1][len(copy):])
            if score >= decontaminate.MIN_SCORE * decontaminate.MATCH * len(text):
                want.add((key, i))
    short = [(900, "qqa"), (901, "qqb qqc"), (902, "qqd qqe qqf")]
    rows += [(9000 + i, " ".join(noise(30) + [t] + noise(30))) for i, t in short] + [(9999, "qqb or qqc qqd qqe")]
    tests = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + short, "item_id long, text string")
    got = {(r.doc_id, h.item_id) for r in decontaminate.find_leaks(documents(rows), tests).select("doc.doc_id", "hits").collect() for h in r.hits}
    assert {(d, i) for d, i in got if i >= 900} == {(9900, 900), (9901, 901), (9902, 902)}
    assert len(want) >= 130 and len(want - got) <= 0.01 * len(want), (len(want), sorted(want - got))
