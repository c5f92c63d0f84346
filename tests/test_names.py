import random
import re

import pytest

from lexmill.operators import names as N


def grams(text):
    out = set()
    for w in re.split(r"[^\w]+|_", text.lower()):
        if w:
            p = f"  {w} "
            out |= {p[i:i + 3] for i in range(len(p) - 2)}
    return out


def brute(values, queries, threshold):
    out = {}
    for q in set(queries) - {None}:
        for v in set(values) - {None}:
            a, b = grams(q), grams(v)
            if a and b and len(a & b) / len(a | b) >= threshold:
                out[q, v] = round(len(a & b) / len(a | b), 9)
    return out


@pytest.mark.parametrize("threshold", [0.15, 0.3, 0.6, 1.0])
def test_search_equals_brute_force(spark, threshold):
    rng = random.Random(int(threshold * 100))
    parts = ["jan", "jansen", "van", "de", "vries", "Straße", "élan", "x", "1a", "müller", "muller", "berg", "bergen"]
    values = [" ".join(rng.choices(parts, k=rng.randrange(1, 5))) for _ in range(300)] + [None, "", "--", "de de de"]
    queries = rng.sample(values[:300], 25) + [None, "", "unknown", "jan-van bergen", "DE VRIES", "a b c d e f g h"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, name string")
    index = N.write_names(df, "name", list_size=7)
    asked = spark.createDataFrame([(q,) for q in queries], "query string")
    got = {(r.query, r.value): round(r.similarity, 9) for r in N.search_names(index, asked, threshold).collect()}
    assert got == brute(values, queries, threshold)
    rows = N.trigram_search(df, "name", asked, threshold).collect()
    assert len(rows) == sum(values.count(v) for _, v in got)
    assert index.lists.selectExpr("max(size(ids))").first()[0] <= 40


def test_lists_skipped_and_folders_named(spark):
    values = [f"smith {i}" for i in range(400)] + ["smith zqx", "smyth zqx"]
    index = N.write_names(spark.createDataFrame([(v,) for v in values], "name string"), "name")
    asked = spark.createDataFrame([("smith zqx",)], "query string")
    read = {r.gram for r in N.short_lists(index, asked, 0.6).collect()}
    assert "smi" not in read and "zqx" in read  # the list of all names is not read
    found = N.candidates(index, asked, 0.6)
    assert found.count() < 10
    plan = found._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ (IN|INSET)", plan) and re.search(r"PushedFilters: \[[^]]*In\(gram", plan)


def test_empty_and_threshold(spark):
    index = N.write_names(spark.createDataFrame([], "name string"), "name")
    assert N.search_names(index, spark.createDataFrame([("a",)], "query string")).count() == 0
    with pytest.raises(ValueError):
        N.search_names(index, spark.createDataFrame([("a",)], "query string"), 0)


@pytest.mark.parametrize("threshold", [0.15, 0.55, 0.8, 0.95, 1.0])
def test_many_queries_equal_brute_force(spark, threshold, monkeypatch):
    monkeypatch.setattr(N, "SCAN", 0)
    monkeypatch.setattr(N, "candidates", None)  # the lists are not read
    rng = random.Random(int(threshold * 100))
    values = [f"Customer#{rng.randrange(10 ** 6):09d}" for _ in range(150)] + ["x", "ab ab", "de de de", None, "--", "Customer#000000011"]
    queries = [f"Customer Supplier#{rng.randrange(10 ** 6):09d}" for _ in range(20)] + rng.sample(values, 20) + ["x", "ab", None, "", "nothing like it", "Customer#000001111"]
    index = N.write_names(spark.createDataFrame([(v,) for v in values], "name string"), "name")
    got = N.search_names(index, spark.createDataFrame([(q,) for q in queries], "query string"), threshold).collect()
    assert len(got) == len({(r.query, r.value) for r in got})
    assert {(r.query, r.value): round(r.similarity, 9) for r in got} == brute(values, queries, threshold)
