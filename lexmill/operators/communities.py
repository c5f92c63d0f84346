"""Communities of the citation graph by modularity (Louvain moves and contraction).

Weights are the numbers of distinct citing pairs between two cases, in either direction. A node
moves to the neighbouring community of highest gain in modularity. Gains are compared as exact
integers (multiplied by the squared total weight), so every engine and partitioning gives the
same communities. Nodes that move at once could swap for ever; a seeded hash therefore parts them in
two halves that take turns.

A round joins the links once with the narrow state of the nodes and sums per (node, community)
with a combining aggregate: the neighbours of a hub are never gathered. Rounds are written to the
shared folder; the driver sees totals only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import cut, forget

SQUARE = "decimal(38,0)"


def communities(edges: DataFrame, rounds: int = 16, levels: int = 8, seed: int = 0) -> DataFrame:
    """(node, community): the community is named by its lowest node.

    A level moves nodes for at most ``rounds`` rounds, or until neither half moves; its communities
    are the nodes of the next level. The last level is the one after which modularity no longer
    rises, or the ``levels``-th. Rows with a null end are left out; a node that only cites itself
    stays alone. No edges give no rows.
    """
    links = cut(weights(edges))
    members = links.select(F.col("a").alias("node"), F.col("a").alias("c")).distinct()
    best = _score(links)
    for level in range(levels if best is not None else 0):
        state, moved = _settle(links, rounds, f"{seed}|{level}")
        if not moved:
            forget(state)
            break
        merged = cut(_contract(links, state))
        score = _score(merged)
        if score <= best:
            forget(state, merged)
            break
        members = cut(members.join(state.select(F.col("a").alias("c"), F.col("c").alias("to")), "c").select("node", F.col("to").alias("c")))
        forget(links, state)
        links, best = merged, score
    names = members.groupBy("c").agg(F.min("node").alias("community"))
    return members.join(names, "c").select("node", "community")


def _pairs(edges: DataFrame) -> DataFrame:
    """(a, b, w) with a <= b, one row for each linked pair; a self citation counts twice."""
    a, b = F.col("source_case_id"), F.col("target_case_id")
    ends = edges.where(a.isNotNull() & b.isNotNull()).select(
        F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.when(a == b, 3).when(a < b, 1).otherwise(2).alias("way"))
    return ends.groupBy("a", "b").agg(F.bit_or("way").alias("ways")).select("a", "b", F.bit_count("ways").cast("long").alias("w"))


def _both(pairs: DataFrame) -> DataFrame:
    """The pairs seen from either end; a self link stays one row."""
    way = lambda x, y: F.struct(F.col(x).alias("a"), F.col(y).alias("b"), "w")
    return pairs.select(F.inline(F.when(F.col("a") == F.col("b"), F.array(way("a", "b"))).otherwise(F.array(way("a", "b"), way("b", "a")))))


def weights(edges: DataFrame) -> DataFrame:
    """(a, b, w) in both directions; a self citation counts twice, so sums over b are degrees."""
    return _both(_pairs(edges))


def _times(x: Column, y: Column) -> Column:
    return x.cast("decimal(19,0)") * y.cast("decimal(18,0)")


def _settle(links: DataFrame, rounds: int, salt: str) -> tuple[DataFrame, bool]:
    """(a, k, c) after the moves of a level, and whether any node moved."""
    state = cut(links.groupBy("a").agg(F.sum("w").alias("k")).select("a", "k", F.col("a").alias("c"), F.lit(False).alias("moved")))
    total = F.lit(state.agg(F.sum("k")).first()[0])
    moves = [0, 0]
    for r in range(rounds):
        half = F.substring(F.md5(F.concat(F.lit(f"{salt}|{r // 2}|"), F.col("a").cast("string"))), 1, 1) < "8"
        turn = half if r % 2 == 0 else ~half  # the other half stays, so its links are not looked at
        sums = state.groupBy("c").agg(F.sum("k").alias("s"))
        own = state.join(sums, "c").select("a", "k", "c", "s")
        seen = links.where("a <> b").where(turn).join(own.select(F.col("a").alias("b"), F.col("c").alias("d"), F.col("s").alias("there")), "b")
        # dealt by node once, for the sums of its communities and for the choice among them
        near = seen.select("a", "d", "w", "there").repartition("a").groupBy("a", "d").agg(F.sum("w").alias("w"), F.max("there").alias("there"))
        worth = _times(total, F.col("w")) - _times(F.col("there"), F.col("k"))
        # every node once, with what its neighbouring communities offer
        offers = near.join(own, "a", "right").groupBy("a", "k", "c", "s").agg(
            F.min(F.when(F.col("d") != F.col("c"), F.struct((-worth).alias("cost"), "d"))).alias("offer"),
            F.max(F.when(F.col("d") == F.col("c"), _times(total, F.col("w")))).alias("kept"))
        stay = F.coalesce("kept", F.lit(0).cast(SQUARE)) - _times(F.col("s") - F.col("k"), F.col("k"))
        goes = F.coalesce((-F.col("offer.cost") > stay) & turn, F.lit(False))
        after = cut(offers.select("a", "k", F.when(goes, F.col("offer.d")).otherwise(F.col("c")).alias("c"), goes.alias("moved")))
        forget(state)
        state = after
        moves.append(state.where("moved").count())
        if r % 2 == 1 and moves[-1] + moves[-2] == 0:
            break
    return state, sum(moves) > 0


def _contract(links: DataFrame, state: DataFrame) -> DataFrame:
    """Links between communities; those inside one become its self link."""
    left = state.select("a", F.col("c").alias("x"))
    right = state.select(F.col("a").alias("b"), F.col("c").alias("y"))
    # a link is met from one of its ends and seen from both again; inside a community both ends count
    ends = links.where("a <= b").join(left, "a").join(right, "b")
    twice = (F.col("x") == F.col("y")) & (F.col("a") < F.col("b"))
    return _both(ends.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.sum(F.when(twice, 2 * F.col("w")).otherwise(F.col("w"))).alias("w")))


def _score(links: DataFrame) -> int | None:
    """Modularity times the squared total weight if every node is a community of its own; null without links."""
    per = links.groupBy("a").agg(F.sum("w").alias("s"), F.sum(F.when(F.col("a") == F.col("b"), F.col("w"))).alias("i"))
    row = per.agg(F.sum("s").alias("total"), F.sum("i").alias("inner"), F.sum(_times(F.col("s"), F.col("s"))).alias("squares")).first()
    return None if row.total is None else int(row.total) * int(row.inner or 0) - int(row.squares)


def community_scores(edges: DataFrame, members: DataFrame) -> DataFrame:
    """(community, size, inner, degree, modularity): what each community adds to the modularity of the graph."""
    pairs = _pairs(edges)
    total = pairs.agg(F.sum(F.when(F.col("a") < F.col("b"), 2 * F.col("w")).otherwise(F.col("w"))).alias("total"))
    of = lambda key, name: members.select(F.col("node").alias(key), F.col("community").alias(name))
    placed = pairs.join(of("a", "here"), "a").join(of("b", "there"), "b")
    # a pair counts from both ends, a self link as one row
    end = lambda c, inner, degree: F.struct(F.col(c).alias("community"), inner.alias("inner"), degree.alias("degree"))
    w, none = F.col("w"), F.lit(0).cast("long")
    ends = placed.select(F.inline(F.when(F.col("a") == F.col("b"), F.array(end("here", w, w))).when(F.col("here") == F.col("there"), F.array(end("here", 2 * w, 2 * w)))
                                  .otherwise(F.array(end("here", none, w), end("there", none, w)))))
    sums = ends.groupBy("community").agg(F.sum("inner").alias("inner"), F.sum("degree").alias("degree"))
    sizes = members.groupBy("community").agg(F.count("*").alias("size"))
    share = F.col("inner") / F.col("total") - (F.col("degree") / F.col("total")) ** 2
    # one row with the total
    return sizes.join(sums, "community").join(F.broadcast(total)).select("community", "size", "inner", "degree", share.alias("modularity"))
