import itertools
from fractions import Fraction

from lexmill.operators import communities as M

SCHEMA = "source_case_id string, target_case_id string"


def modularity(edges, placed):
    e = {(a, b) for a, b in edges if a is not None and b is not None}
    links = [p for a, b in e for p in ((a, b), (b, a))]
    out = Fraction(0)
    for c in set(placed.values()):
        degree = sum(placed[a] == c for a, _ in links)
        out += Fraction(sum(placed[a] == c == placed[b] for a, b in links), len(links)) - Fraction(degree, len(links)) ** 2
    return out


def run(spark, edges, **more):
    df = spark.createDataFrame(edges, SCHEMA).repartition(3)
    out = M.communities(df, **more)
    rows = out.collect()
    assert len(rows) == len({r.node for r in rows})
    return df, out, {r.node: r.community for r in rows}


def cliques(n, size):
    names = [[f"{chr(97 + i)}{j}" for j in range(size)] for i in range(n)]
    inside = [p for g in names for p in itertools.combinations(g, 2)]
    return names, inside + [(names[i][0], names[(i + 1) % n][1]) for i in range(n)]


def test_cliques_in_a_ring_are_found(spark):
    names, edges = cliques(6, 5)
    df, out, placed = run(spark, edges + edges[:4] + [(None, "a1"), ("a1", None)])
    assert placed == {x: min(g) for g in names for x in g}
    scores = {r.community: r for r in M.community_scores(df, out).collect()}
    assert abs(sum(r.modularity for r in scores.values()) - float(modularity(edges, placed))) < 1e-12
    assert all(r.size == 5 and r.inner == 20 and r.degree == 22 for r in scores.values())


def test_levels_never_lower_modularity(spark):
    edges = [(f"n{a:02}", f"n{b:02}") for a in range(60) for b in range(60) if a != b and (a * 7 + b * 13) % 61 < (9 if a // 20 == b // 20 else 1)]
    last = Fraction(-1)
    for levels in (1, 8):
        _, _, placed = run(spark, edges, levels=levels)
        now = modularity(edges, placed)
        assert now >= last and now > Fraction(3, 10)
        last = now


def test_a_settled_level_has_no_better_move(spark):
    names, edges = cliques(3, 4)
    _, _, placed = run(spark, edges, levels=1, rounds=30)
    base = modularity(edges, placed)
    for node, other in itertools.product(placed, set(placed.values())):
        assert modularity(edges, {**placed, node: other}) <= base


def test_hub_self_citations_and_empty(spark):
    star = [("hub", f"x{i:03}") for i in range(300)]
    _, _, placed = run(spark, star + [("solo", "solo")])
    assert placed.pop("solo") == "solo" and set(placed.values()) == {"hub"}
    assert run(spark, [("solo", "solo")])[2] == {"solo": "solo"}
    df, out, placed = run(spark, [(None, "a")])
    assert placed == {} and M.community_scores(df, out).count() == 0


def test_same_seed_same_result(spark):
    _, edges = cliques(3, 4)
    first = run(spark, edges, seed=3)[2]
    again = M.communities(spark.createDataFrame(edges[::-1], SCHEMA).repartition(7), seed=3)
    assert {r.node: r.community for r in again.collect()} == first
