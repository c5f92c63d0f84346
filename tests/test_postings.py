import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from lexmill.operators import postings as P


@given(st.lists(st.integers(0, (1 << 41) - 1)))
def test_packed_numbers_come_back(values):
    data, offsets = P.packed(np.array(values, np.int64))
    assert P.unpacked(data).tolist() == values and offsets[-1] == len(data)


def words(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def brute(rows, mode, terms):
    out = {}
    for key, text in rows:
        w, terms = words(text), [t.lower() for t in terms]
        held = [t for t in dict.fromkeys(terms) if t in w]
        fits = {"any": bool(held), "all": len(held) == len(set(terms)), "phrase": any(w[i:i + len(terms)] == terms for i in range(len(w)))}[mode]
        if fits and terms:
            found = len(held), sum(w.count(t) for t in held)
            out[key] = tuple(max(x) for x in zip(found, out.get(key, (0, 0))))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(60)] + ["Straße", "été", "x1y2"]
    weights = [1 / (i + 1) for i in range(63)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(60))) + rng.choice(["", ".", " t0, T1"])) for i in range(900)]
    return rows + [(2000, None), (2001, ""), (2002, " ,;"), (2003, "t0 " * 3000), (7, "t0 t1 again"), (None, "t0 t1")]


@pytest.mark.parametrize("zone, block", [(2_000_000, 128), (700, 4)])
def test_search_equals_brute_force(spark, rows, zone, block):
    df = spark.createDataFrame(rows, "k long, text string").repartition(3)
    index = P.write_index(df, ["k"], zone_tokens=zone, block=block)
    asked = {
        "a": ("all", ["t0", "t1"]), "b": ("any", ["t40", "t55", "nowhere"]), "c": ("phrase", ["t0", "t0", "t1"]), "d": ("all", ["nowhere", "t0"]), "e": ("phrase", ["T3", "t0"]),
        "f": ("phrase", ["t0"]), "g": ("all", ["straße", "été"]), "h": ("phrase", ["t1", "t0", "t2", "t0"]), "i": ("all", []), "j": ("all", ["t0", "t0"]), "k": ("any", ["x1y2"])}
    got = {}
    for r in P.search(index, P.ask(spark, **asked)).collect():
        got.setdefault(r.query_id, {})[r.k] = (r.terms, r.score)
    for name, (mode, terms) in asked.items():
        assert got.get(name, {}) == brute(rows, mode, terms), name
    counted = {(r.token, r.k): r.frequency for r in P.frequencies(index).collect()}
    want = {}
    for k, text in rows:
        for w in words(text):
            want[w, k] = want.get((w, k), 0) + 1
    assert counted == want


def test_skips_spare_blocks():
    n = 10_000
    docs = np.concatenate([np.arange(n), np.arange(0, n, 1000)])
    order = np.lexsort((np.repeat([0, 1], [n, 10]), docs))
    codes = np.repeat([0, 1], [n, 10])[order]
    found = P.zone_postings(codes, docs[order], np.where(codes == 1, 1, 0))
    common, rare = (P.Postings(*(found[c][i].as_py() for c in ("skips", "docs", "counts", "places"))) for i in (0, 1))
    doc, _, score = P.matching({"common": common, "rare": rare}, ["common", "rare"], "phrase")
    assert doc.tolist() == list(range(0, n, 1000)) and set(score) == {2}
    assert common.decoded <= 10 * P.BLOCK < n / 5


def test_search_reads_only_the_folders_of_its_tokens(spark, rows):
    index = P.write_index(spark.createDataFrame(rows, "k long, text string"), ["k"])
    plan = P.search(index, P.ask(spark, q=("all", ["t0", "t1"])))._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ (IN|INSET)", plan) and re.search(r"PushedFilters: \[[^]]*In\(token", plan)


def test_empty(spark):
    index = P.write_index(spark.createDataFrame([], "k long, text string"), ["k"])
    assert P.search(index, P.ask(spark, q=("any", ["a"]))).count() == 0 and P.frequencies(index).count() == 0
