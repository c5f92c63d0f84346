import random
import re

from lexmill.llm import mixing


def targets(sizes, weights, share, ceiling):
    """Shares by weight, the excess over the ceiling reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while True:
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > ceiling * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = ceiling * sizes[s]
            left -= out[s]
        free -= over


def test_targets_and_words(documents):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 120)), rng.choice(["a", "a", "a", "a", "b", "c", "d", None])) for i in range(600)]
    rows += [(1000, None, "a"), (1001, "", "z"), (None, "no id here", "b"), (5, "same row", "c"), (5, "same row", "c"), (2000, "w " * 3000, "d")]
    sizes, count = {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"\S+", t or ""))
        count[s] = count.get(s, 0) + 1
    docs = documents(rows)
    got = mixing.mix(docs).select("doc.doc_id", "doc.k1", "source", "size", "source_size", "target", "rate", "copies", "taken").collect()
    assert len(got) == len(rows)
    want = targets(sizes, (3, 1, 2), 1.5, 2.0)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert len(own) == count[s] and {r.source_size for r in own} == {sizes[s]}
        assert all(abs(r.target - want[s]) <= 1e-6 * max(1, want[s]) for r in own)
        assert all(r.copies in (0, 1, 2) and r.taken == r.copies * r.size for r in own)
        assert all(abs(r.copies - r.rate) < 1 + 1e-6 or r.size == 0 for r in own)
        taken = sum(r.taken for r in own)
        assert abs(taken - want[s]) <= max(0.02 * want[s], 60), (s, taken, want[s])
        # the tilted rates themselves come to the target
        assert abs(sum(r.rate * r.size for r in own) - want[s]) <= 1e-6 * max(1, want[s])
    again = mixing.mix(docs).select("doc.doc_id", "source", "size", "taken").collect()
    assert sorted(map(repr, again)) == sorted(repr(type(again[0])(doc_id=r.doc_id, source=r.source, size=r.size, taken=r.taken)) for r in got)
    repeated = mixing.repeated(mixing.mix(docs))
    assert repeated.columns == docs.columns and repeated.count() == sum(r.copies for r in got)


def test_shrinking_sources_and_empty(documents):
    rows = [(i, "w " * (i % 7 + 1), "a" if i % 10 else "b") for i in range(300)]
    got = mixing.mix(documents(rows), weights=(1, 1), share=0.5, ceiling=2.0).select("source", "target", "taken").collect()
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 8
    assert mixing.mix(documents([])).collect() == []
    assert [r.taken for r in mixing.mix(documents([(1, None, None), (2, "", None)])).collect()] == [0, 0]


def test_a_ceiling_between_whole_numbers(documents):
    got = mixing.mix(documents([(i, "a b c d", "a") for i in range(100)]), share=1.5, ceiling=1.5).select("target", "copies", "taken").collect()
    assert {r.target for r in got} == {600.0} and {r.copies for r in got} == {1, 2}
    assert abs(sum(r.taken for r in got) - 600) <= 4
